"""Schemas of the tables that are read and written."""

SOURCE = "source_idx int, domain string, url string, note string"
VIDEO_INFO = "id string, webpage_url string, subtitles array<struct<lang:string,formats:array<struct<ext:string,url:string>>>>, entries array<struct<webpage_url:string,url:string>>"
CUE = "video_id string, cue_idx int, start double, end double, text string"
SEGMENT = "video_id string, seg_ord int, start double, end double, text string"
HIT = "struct<surface:string,abbr:string,canonical_reading:string,pron_type:string,confidence_tier:string,rule_id:string,span_start:int,span_end:int,is_rule_confirmed:boolean>"
RARE_MANIFEST = "uid bigint, URL string, start double, end double, text string, audio_path string, video_id string, subtitle_lang string, domain string, rare_words array<string>, freq_1_9_words array<string>, oov_words array<string>, entities array<string>, subtitle_path string, source_domain string, source_note string"
ABBR_MANIFEST = f"uid bigint, URL string, video_id string, start double, end double, audio_path string, subtitle_path string, text string, text_expanded string, abbreviations array<{HIT}>, primary_abbr string, primary_pron_type string, primary_confidence_tier string, source_domain string, source_note string"
CANDIDATE_MANIFEST = ABBR_MANIFEST + ", match_mode string"
RULE = "abbr string, canonical_reading string, pron_type string, confidence_tier string, rule_id string, variants array<string>, notes string"
MONITOR_STATE = "saved_count bigint, live_clip_count bigint, log_offset bigint, current_source string, abnormal_streak int, timestamp string"
ITEM = f"struct<id:int,abbr:string,surface:string,text:string,text_expanded:string,audio_file:string,original_uid:bigint,video_id:string,URL:string,start:double,end:double,source_domain:string,source_note:string,primary_pron_type:string,primary_confidence_tier:string,match_mode:string,abbreviation:struct<abbr:string,surface:string,span_start:int,span_end:int,pron_type:string,confidence_tier:string,canonical_reading:string,rule_id:string,is_rule_confirmed:boolean>,original_audio_path:string>"
