import random
import re

import pytest

from cuemill.operators.segment import segments
from cuemill.sources.subtitles import parse_cues

CASES = [
    ([(0, 3, "Hi."), (3, 7, "There now.")], [(0, 7, "Hi. There now.")]),
    ([(0, 6, "a"), (7.3, 13, "b.")], [(0, 6, "a"), (7.3, 13, "b.")]),
    ([(0, 6, "a"), (7.2, 13, "b.")], [(0, 6, "a"), (7.2, 13, "b.")]),
    ([(0, 1.0, "a"), (2.2, 6.5, "b.")], []),
    ([(0, 20, "a"), (20, 31, "b")], []),
    ([(0, 20, "a"), (20, 30, "b")], [(0, 30, "a b")]),
    ([(0, 2, "a"), (2, 4, "b.")], []),
    ([(0, 3, "a"), (3, 6, 'b."'), (6, 9, "c.")], [(0, 9, 'a b." c.')]),
]


def run(spark, cues):
    rows = [("v", i, float(a), float(b), t) for i, (a, b, t) in enumerate(cues)]
    got = segments(spark.createDataFrame(rows, "video_id string, cue_idx int, start double, end double, text string"))
    return [(r.start, r.end, r.text) for r in got.orderBy("seg_ord").collect()]


@pytest.mark.parametrize(("cues", "want"), CASES)
def test_cases(spark, cues, want):
    assert run(spark, cues) == want


def plain_fold(cues):
    out, now = [], None
    for a, b, t in cues:
        if now is None or a - now[1] > 1.2:
            if now:
                out.append(now)
            now = [a, b, t]
            continue
        now = [now[0], max(now[1], b), f"{now[2]} {t}"]
        if now[1] - now[0] >= 30 or re.search(r"[.!?。！？]$", t):
            out.append(now)
            now = None
    return [tuple(x) for x in [*out, *([now] if now else [])] if 5 <= x[1] - x[0] <= 30]


def test_random_videos(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for v in range(40):
        at, cues = 0.0, []
        for i in range(rng.randint(1, 30)):
            at = round(at + rng.choice([0, 0.2, 1.2, 1.3, 2]), 3)
            end = round(at + rng.uniform(0.5, 9), 3)
            cues.append((at, end, rng.choice(["a", "b.", "c?", "d"])))
            rows.append((str(v), i, at, end, cues[-1][2]))
            at = end
        want[str(v)] = plain_fold(cues)
    got = segments(spark.createDataFrame(rows, "video_id string, cue_idx int, start double, end double, text string")).orderBy("video_id", "seg_ord").collect()
    found = {v: [] for v in want}
    for r in got:
        found[r.video_id].append((r.start, r.end, r.text))
    assert found == want


def test_subtitles(spark):
    body = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\nHello <b>you</b>\nthere\n\nstray\n00:03.00 --> 00:04.00\nNOTE x\nA &amp; B\n00:05,000 --> 00:06,000\n[Music playing]\n\n00:07.000 --> 00:08.000\n\n00:09.00 --> 00:10.00\nend"
    got = parse_cues(spark.createDataFrame([("v", body)], "video_id string, body string")).orderBy("cue_idx").collect()
    assert [(r.start, r.end, r.text) for r in got] == [(1.0, 2.5, "Hello you there"), (3.0, 4.0, "A & B"), (9.0, 10.0, "end")]
