"""Fixed schemas of the tables the operators read and write."""

from __future__ import annotations

NOTE = "score_id string, note_idx int, onset_s double, offset_s double, pitch_midi int, lyric string"
FRAME = "sample_id string, frame_idx bigint, t_s double, f0_hz double, voiced boolean"
RMS_FRAME = "sample_id string, frame_idx bigint, t_s double, rms double"
POSTERIOR = "song_id string, frame bigint, pitch int, onset_p double, frame_p double"

VERDICT = (
    "struct<status:string,onset_ok:boolean,offset_ok:boolean,f0_ok:boolean,"
    "snr_db:double,reason:string,max_onset_dev_ms:double>"
)
ACCOMPANIMENT = (
    "struct<mode:string,model_id:string,model_version:string,model_license:string,"
    "attribution_text:string,vocal_bit_exact:boolean,source_vocal_sample_id:string,"
    "takes_tried:int,max_note_shift_ms:double,free_time:boolean,target_instrument:string,"
    "stem_available:boolean>"
)
MANIFEST = (
    "sample_id string, score_id string, score_path string, audio_path string, lane string, "
    "voice_id string, augmentation_profile string, seed bigint, voice_license string, "
    f"consent_verified boolean, config_hash string, verdict {VERDICT}, lyric_source string, "
    "lyric_hash string, lyric_model string, lyric_model_license string, lyric_articulated boolean, "
    f"lyric_multisyllable_supplied int, lyric_language string, accompaniment {ACCOMPANIMENT}, "
    "base_score_id string, score_aug_profile string, score_aug_axis string, "
    "score_aug_transform string, score_aug_seed bigint, dynamics_applied boolean, "
    "score_source string, score_license string, notes map<string,string>"
)
SIDECAR = "source string, license string, url string"
VOICE = "voice_id string, kind string, license string, consent_verified boolean, model_ref string"
PARALLEL_NOTES = (
    "segment_id string, note_midi array<double>, note_lyrics array<string>, "
    "note_start_times array<double>, note_end_times array<double>"
)
