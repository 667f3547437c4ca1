"""The miners against a plain loop over the same inputs, resumed runs, and the commands."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cuemill import cli, connectors, schemas, sinks
from cuemill.config import AbbreviationConfig, RareWordConfig, SegmentConfig
from cuemill.operators import abbr, mining, package, stats
from cuemill.sources import files
from cuemill.sources.rules import check, quota_plan
from cuemill.sources.subtitles import parse_cues

RULES = [("DNA", "d n a", "spell_out", "high_conf"), ("RNA", "r n a", "spell_out", "low_conf"), ("mRNA", "m r n a", "camel_case", "high_conf"), ("H5N1", "h five", "mixed_alnum", "low_conf")]
WORDS = ["cell", "the", "odd", "queer", "zyx", "DNA", "RNA", "mRNA", "H5N1", "plasma", "Big Bang"]


def rules():
    return check([{"abbr": a, "canonical_reading": r, "pron_type": p, "confidence_tier": t, "rule_id": "", "variants": "", "notes": ""} for a, r, p, t in RULES])


def clock(t):
    return f"00:{int(t // 60):02d}:{t % 60:06.3f}"


@pytest.fixture(scope="module")
def world(tmp_path_factory):
    """Seeds, listings, infos, vocabularies and subtitle files of a small world, on disk."""
    rng, home = random.Random(5), tmp_path_factory.mktemp("world")
    subs = home / "subtitles"
    subs.mkdir()
    listings, infos = [], []
    for s in range(4):
        entries = []
        for v in range(4):
            url, vid = f"https://e.example/watch?v={s}{v}", f"vid{s}{v}"
            entries.append({"webpage_url": url, "url": ""})
            if (s, v) != (1, 1):
                infos.append({"url": url, "id": vid, "webpage_url": url if v else "", "subtitles": {"de": [], "EN" if v == 2 else "en": []} if (s, v) != (2, 2) else {"fr": []}})
            at, out = 0.0, ["WEBVTT", ""]
            for _ in range(rng.randint(6, 14)):
                text = " ".join(rng.choice(WORDS) for _ in range(3)) + rng.choice([".", "", ","])
                out += [f"{clock(at)} --> {clock(at + 3.5)}", rng.choice([text, f"<i>{text}</i>"]), ""]
                at += rng.choice([3.5, 3.6, 6.0])
            (subs / f"{vid}.{'EN' if v == 2 else 'en'}.vtt").write_text("\n".join(out))
        listings.append({"source_url": f"https://e.example/list/{s}", "entries": entries})
    (home / "seeds.tsv").write_text("# seeds\n" + "".join(f"{d}\thttps://e.example/list/{i}\tnote {i}\n" for i, d in enumerate(["unknown", "multi", "biology", "physics", "biology"])))
    (home / "listings.json").write_text("".join(json.dumps(x) + "\n" for x in listings))
    (home / "infos.json").write_text("".join(json.dumps(x) + "\n" for x in infos))
    (home / "one.txt").write_text("cell\t9\nthe\t9\nodd\t3\nplasma\t40\n")
    (home / "ten.txt").write_text("the\nplasma\n")
    (home / "rules.tsv").write_text("abbr\tcanonical_reading\tpron_type\tconfidence_tier\trule_id\tvariants\tnotes\n" + "".join("\t".join(r) + "\t\t\t\n" for r in RULES))
    return home


def found(spark, world):
    return mining.find(files.seed_sources(spark, f"{world}/seeds.tsv"), files.listings(spark, f"{world}/listings.json"), files.infos(spark, f"{world}/infos.json"), cli.subtitles.read_subtitles(spark, f"{world}/subtitles"))


def tried(segments):
    """Segments as a plain list, in the order in which the miners see them."""
    return [r.asDict(True) for r in segments.orderBy("item_id").collect()]


def test_find(spark, world):
    got = found(spark, world)
    videos = {(r.source_idx, r.video_idx): r for r in got.videos.collect()}
    assert len(videos) == 16 and videos[1, 1].failed and videos[2, 2].lang is None and videos[0, 2].lang == "EN"
    assert videos[0, 0].URL_ == "https://e.example/watch?v=00"
    assert {(r.source_idx, r.video_idx) for r in got.segments.collect()} == {*videos} - {(1, 1), (2, 2)}


@pytest.mark.parametrize(("target", "per_video", "per_domain", "mode"), [(1000, 30, 0, "text"), (12, 2, 5, "segment"), (7, 3, 0, "none")])
def test_rare_words_against_a_plain_loop(spark, world, target, per_video, per_domain, mode):
    got = found(spark, world)
    vocab = files.vocabulary(spark, f"{world}/one.txt", f"{world}/ten.txt")
    config = RareWordConfig(target_count=target, max_per_video=per_video, max_per_domain=per_domain, require_keyword=False, dedup_key=mode)
    made = mining.mine_rare_words(got, vocab, config=config, out_dir="/out")
    low, high = {"cell", "the", "odd", "plasma"}, {"the", "plasma"}
    want, seen, videos, domains = [], set(), {}, {}
    for s in tried(got.segments):
        words = {w for w in re.findall(r"\b[a-zA-Z']+\b", s["text"]) if w.islower()}
        rare = sorted({w for w in words if w not in low or w not in high})
        every = {w.lower() for w in re.findall(r"\b[a-zA-Z']+\b", s["text"])}
        detected = {"biology": len({"cell", "dna", "rna"} & every), "physics": len({"plasma"} & every)}
        best = [d for d in sorted(detected, key=lambda d: -detected[d]) if detected[d]]
        domain = s["domain"] if s["domain"] not in ("unknown", "multi") else best[0] if best else s["domain"]
        key = {"text": s["text"].strip().lower(), "segment": f"{s['video_id']}:{s['start']:.3f}:{s['end']:.3f}", "none": None}[mode]
        if len(want) >= target or videos.get(s["video_id"], 0) >= per_video or key in seen or not 1 <= len(rare) <= 3 or per_domain and domains.get(domain, 0) >= per_domain:
            continue
        seen |= {key} - {None}
        videos[s["video_id"]] = videos.get(s["video_id"], 0) + 1
        domains[domain] = domains.get(domain, 0) + 1
        want.append((len(want) + 1, s["video_id"], s["text"], domain, rare, s["source_idx"], s["video_idx"]))
    rows = made.records.orderBy("uid").collect()
    assert [(r.uid, r.video_id, r.text, r.domain, r.rare_words) for r in rows] == [w[:5] for w in want]
    assert made.records.columns == [x.split(" ")[0] for x in schemas.RARE_MANIFEST.split(", ")]
    full = len(want) >= target
    last = want[-1][5:]
    document = mining.stats_document(made, "rare_words", target)
    inspected = sum((s, v) <= last for s in range(4) for v in range(4)) if full else 16
    assert document["inspected_videos"] == inspected and document["kept_videos"] == len({w[5:] for w in want})
    assert document["video_info_failures"] == (1 if not full or last >= (1, 1) else 0) and document["source_expand_failures"] == (0 if full else 1)
    assert document["domain_counter"] == domains and list(document["domain_counter"]) == list(domains)


def test_abbreviations_against_a_plain_loop(spark, world):
    got = found(spark, world)
    config = AbbreviationConfig(target_count=14, max_per_video=3, max_per_abbr=6, max_abbrs_per_sentence=3)
    made = mining.mine_abbreviations(got, rules(), config=config)
    pron_quota, tier_quota = quota_plan(rules(), 14)
    table = {r[0]: r for r in RULES}
    want, seen, videos, counts = [], set(), {}, {"abbr": {}, "pron": {}, "tier": {}}
    rows = tried(got.segments.withColumn("n", F.size(abbr.X.abbreviation_candidates(F.col("text")))))
    for s in sorted(rows, key=lambda s: (s["source_idx"], s["video_idx"], s["n"], s["start"], s["seg_ord"])):
        hits = [table[w] for w in re.findall(r"\b(?:mRNA|DNA|RNA|H5N1)\b", s["text"])]
        if len(want) >= 14 or videos.get(s["video_id"], 0) >= 3 or s["text"].lower() in seen or not 1 <= len(hits) <= 3:
            continue
        first = min(enumerate(hits), key=lambda x: (x[1][3] != "high_conf", x[1][2] == "spell_out", x[1][0], x[0]))[1]
        if any(counts["abbr"].get(h[0], 0) >= 6 for h in hits):
            continue
        if any(0 < q.get(v, 0) <= counts[k].get(v, 0) and any(counts[k].get(x, 0) < n for x, n in q.items()) for k, q, v in (("pron", pron_quota, first[2]), ("tier", tier_quota, first[3]))):
            continue
        seen.add(s["text"].lower())
        videos[s["video_id"]] = videos.get(s["video_id"], 0) + 1
        for k, i in (("abbr", 0), ("pron", 2), ("tier", 3)):
            for v in {h[i] for h in hits}:
                counts[k][v] = counts[k].get(v, 0) + 1
        want.append((len(want) + 1, s["video_id"], s["text"], first[0]))
    assert [(r.uid, r.video_id, r.text, r.primary_abbr) for r in made.records.orderBy("uid").collect()] == want and len(want) > 8
    document = mining.stats_document(made, "abbreviations", 14)
    assert (document["abbr_counter"], document["pron_type_counter"], document["confidence_tier_counter"]) == tuple(dict(sorted(counts[k].items())) for k in ("abbr", "pron", "tier"))


def test_rule_tables_of_any_size_give_the_same(spark, world, monkeypatch):
    rows = found(spark, world).segments
    small = abbr.score(rows, rules(), 3).select("item_id", "abbreviations", "text_expanded", "primary_abbr").orderBy("item_id").collect()
    many = rules() + check([{"abbr": f"QQ{i}", "canonical_reading": "q", "pron_type": "other", "confidence_tier": "low_conf"} for i in range(abbr.LITERAL_VARIANTS)])
    assert abbr.score(rows, many, 3).select("item_id", "abbreviations", "text_expanded", "primary_abbr").orderBy("item_id").collect() == small


def test_clips_that_fail_are_left_out(spark, world):
    got = found(spark, world)
    config = AbbreviationConfig(target_count=9, max_per_video=2, max_per_abbr=50, max_abbrs_per_sentence=3)
    plain = [r.text for r in mining.mine_candidates(got, config=config).records.orderBy("uid").collect()]
    bad = F.col("text").isin(plain[1], plain[4])
    made = mining.mine_candidates(got, config=config, audio=True, out_dir="/out", cut=lambda rows: rows.filter(bad)).records.orderBy("uid").collect()
    assert [r.uid for r in made] == [*range(1, 10)] and not {r.text for r in made} & {plain[1], plain[4]}
    assert all(r.audio_path.startswith("/out/clips_wav/") and r.match_mode == "candidate_only" for r in made)


def command(world, name, out, *more):
    extra = {"mine-rare": ["--vocab-min1", f"{world}/one.txt", "--vocab-min10", f"{world}/ten.txt", "--no-require-science-keyword"], "mine-abbreviations": ["--rule-file", f"{world}/rules.tsv", "--max-abbrs-per-sentence", "3"], "mine-candidates": []}[name]
    return [name, "--seed-file", f"{world}/seeds.tsv", "--listings", f"{world}/listings.json", "--infos", f"{world}/infos.json", "--subtitles", f"{world}/subtitles", "--out-dir", str(out), *extra, *more]


@pytest.mark.parametrize("name", ["mine-rare", "mine-abbreviations", "mine-candidates"])
def test_commands_and_resumed_runs(spark, world, tmp_path, name):
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    assert cli.main(command(world, name, whole, "--target-count", "16", "--save-every", "0"), spark) == 0
    assert cli.main(command(world, name, parts, "--target-count", "5", "--save-every", "2", "--sources-at-once", "1"), spark) == 0
    assert json.loads((parts / "stats.json").read_text())["final_count"] == 5
    quota = name == "mine-abbreviations"  # its quotas follow from the target, so a run to 5 takes other records
    if not quota:
        assert cli.main(command(world, name, parts, "--target-count", "16", "--resume"), spark) == 0
        own = lambda p: [{k: v for k, v in x.items() if k != "audio_path"} for x in json.loads((p / "manifest.json").read_text())]
        assert own(parts) == own(whole)
    once = (parts / "manifest.jsonl").read_text()
    assert cli.main(command(world, name, parts, "--target-count", "5", "--resume"), spark) == 0  # the target is met
    assert (parts / "manifest.jsonl").read_text() == once
    if name != "mine-rare":
        rows = (parts / "rule_audit.jsonl").read_text().splitlines()
        assert len(rows) == len((parts / "sample_review.tsv").read_text().splitlines()) - 1 > 4
        assert (parts / "sample_review.tsv").read_text().split("\n")[0].split("\t")[0:2] == ["uid", "abbr"]
    assert cli.main(command(world, name, tmp_path / "x", "--fail-on-source-expand-error"), spark) == 1


def test_package_refine_and_manifest_files(spark, world, tmp_path):
    out = tmp_path / "run"
    assert cli.main(command(world, "mine-abbreviations", out, "--path-mode", "relative"), spark) == 0
    rows = [json.loads(x) for x in (out / "manifest.jsonl").read_text().splitlines()]
    for r in rows:
        (tmp_path / f"{r['uid']}.wav").write_text("wav")
        r["audio_path"] = str(tmp_path / f"{r['uid']}.wav") if r["uid"] != 2 else str(tmp_path / "missing.wav")
    (tmp_path / "manifest.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    packed, refined = tmp_path / "packed", tmp_path / "refined"
    assert cli.main(["package", "--input-manifest", f"{tmp_path}/manifest.jsonl", "--output-dir", str(packed)], spark) == 0
    document, report = (json.loads((packed / x).read_text()) for x in ("metadata.json", "selection_report.json"))
    assert document["num_items"] == len(document["items"]) == report["selected_records"] == len({r["primary_abbr"] for r in rows}) and report["score_stats"]["skipped_missing_audio"] == 1
    assert all(k in document["items"][0] for k in ("match_mode", "abbreviation", "original_uid")) and document["items"][0]["match_mode"] is None
    gone = document["items"][0]["abbr"]
    (tmp_path / "deny.txt").write_text(f"# no\n\u00a0{gone} \n")
    assert cli.main(["refine", "--input-metadata", f"{packed}/metadata.json", "--output-dir", str(refined), "--denylist-file", f"{tmp_path}/deny.txt"], spark) == 0
    after, totals = (json.loads((refined / x).read_text()) for x in ("metadata.json", "selection_report.json"))
    assert after["num_items"] == document["num_items"] - 1 and totals["removed_examples"] == [gone] and after["items"][0]["audio_file"].startswith("audio/00001_00002_")
    import zipfile

    assert zipfile.ZipFile(refined / "audio.zip").namelist() == [x["audio_file"] for x in after["items"]]
    nulls = spark.createDataFrame([(2, None, "é"), (1, 1.5, None)], "uid long, a double, b string")
    sinks.write_manifest(nulls, f"{tmp_path}/m.json", f"{tmp_path}/m.jsonl")
    want = [{"uid": 1, "a": 1.5, "b": None}, {"uid": 2, "a": None, "b": "é"}]
    assert (tmp_path / "m.json").read_text() == json.dumps(want, ensure_ascii=False, indent=2)
    assert (tmp_path / "m.jsonl").read_text() == "".join(json.dumps(x, ensure_ascii=False) + "\n" for x in want)


def test_cues_against_a_plain_reader(spark):
    span = re.compile(r"(\d{1,2}:\d{2}(?::\d{2})?[.,]\d{2,3})\s*-->\s*(\d{1,2}:\d{2}(?::\d{2})?[.,]\d{2,3})")

    def plain(body):
        out, now = [], None
        for line in map(str.strip, body.splitlines()):
            if m := span.search(line):
                now = [m.group(1), []]
                out.append(now)
            elif not line:
                now = None
            elif now and not line.startswith(("NOTE", "STYLE", "WEBVTT")):
                now[1].append(line)
        return [" ".join(" ".join(t).split()) for _, t in out if t]

    rng = random.Random(3)
    pool = ["00:01.000 --> 00:02.50", " 1:00:01,000-->1:00:02,500 align", "", " ", "text", "more  text ", "NOTE x", "STYLE", "7", "\u00a0", "WEBVTT", "\ue000odd"]
    bodies = [rng.choice(["\n", "\r\n"]).join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    got = parse_cues(spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "video_id string, body string"))
    own = {r.video_id: [x.text for x in sorted(r.c)] for r in got.groupBy("video_id").agg(F.collect_list(F.struct("cue_idx", "text")).alias("c")).collect()}
    for i, b in enumerate(bodies):
        assert own.get(str(i), []) == plain(b.replace("\ue000", "\ufffd"))


def test_programs(spark, tmp_path):
    """Stand-ins for the downloader and the cutter, run by the executors."""
    get, cut = tmp_path / "get", tmp_path / "cut"
    get.write_text("#!/bin/sh\nfor x; do last=$x; done\ncase $last in *bad*) echo broken >&2; exit 3;; esac\ncase \"$*\" in *wav*) for x; do case $x in */full_audio/*) echo a > $(dirname $x)/v.wav;; esac; done;; *) echo '{\"id\": \"v\", \"entries\": []}';; esac\n")
    cut.write_text("#!/bin/sh\nfor x; do last=$x; done\ncase $last in *000005000*) exit 1;; esac\necho c > $last\n")
    get.chmod(0o755), cut.chmod(0o755)
    programs = connectors.Programs(str(get), str(cut), retries=1, backoff=0)
    assert programs.missing(True) == [] and connectors.Programs("no-such-program").missing(False) == ["no-such-program"]
    rows = connectors.describe_urls(spark.createDataFrame([("https://good",), ("https://bad",)], "url string"), programs).collect()
    assert {r.url: (r.json is not None, r.error) for r in rows} == {"https://good": (True, None), "https://bad": (False, "broken\n")}
    make = connectors.cut_clips(programs, str(tmp_path))
    rows = spark.createDataFrame([(1, "v", "https://u", 1.0, 2.0), (2, "v", "https://u", 5.0, 6.0)], "item_id long, video_id string, URL_ string, start double, end double")
    assert [r.item_id for r in make(rows).collect()] == [2]
    assert (tmp_path / "clips_wav" / "v_000001000_000002000.wav").exists() and not (tmp_path / "full_audio" / "v.wav").exists()


def test_limits_of_nothing(spark, world):
    got = found(spark, world)
    assert mining.mine_candidates(got, config=AbbreviationConfig(max_per_abbr=0)).records.count() == 0
    assert mining.mine_candidates(mining.find(files.seed_sources(spark, f"{world}/seeds.tsv"), files.listings(spark, f"{world}/listings.json").limit(0), files.infos(spark, f"{world}/infos.json"), cli.subtitles.read_subtitles(spark, f"{world}/subtitles"), cut=SegmentConfig())).stats["source_expand_failures"] == 5
    assert stats.as_map(stats.counter(got.segments, "lang"), "lang").first()[0].keys() == {"EN", "en"}
    assert package.IDEAL_WORDS == 12


@pytest.mark.parametrize("kind", ["rare", "candidates"])
def test_segments_are_made_once(spark, world, kind):
    """Selection, records and counters don't parse the files again."""
    got, seen = found(spark, world), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    n = got.segments.count()
    got = mining.Found(got.sources, got.videos, got.segments.mapInPandas(count, got.segments.schema))
    if kind == "rare":
        vocab = files.vocabulary(spark, f"{world}/one.txt", f"{world}/ten.txt")
        made = mining.mine_rare_words(got, vocab, config=RareWordConfig(require_keyword=False, dedup_key="segment"))
    else:
        made = mining.mine_candidates(got, config=AbbreviationConfig(dedup_key="segment"))
    assert made.records.count() > 0 and seen.value == n
