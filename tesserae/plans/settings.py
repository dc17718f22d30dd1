"""Settings of the stages, with the defaults that hold where nothing is said."""

from __future__ import annotations

import os

# Settings that change results, and their defaults, by stage.
SETTINGS = {
    "clean": {
        "max_words": 500, "batch_size": 25, "rate_limit_delay": 0.1, "chunk_size": 100, "max_consecutive_failures": 50, "keep_document_types": ["speech", "interview", "official_statement"], "require_leader_type": True,
        "tenure_window": 1, "date_flag_years": 5, "date_text_enabled": True, "date_text_lines": 4, "date_text_max_line_chars": 60, "date_text_min_year": 1990, "date_text_dateparser": True, "date_text_first": False,
        "date_pass_enabled": True, "date_pass_max_words": 200, "date_pass_max_tokens": 200, "compression": "zstd",
    },
    "translate": {
        "translator": "google", "target_language": "en", "fields": ["text", "title", "context"], "only_accepted": True, "max_chunk_chars": 4500, "pause_every": 50, "pause_seconds": 1.0, "call_delay": 0.5, "retries": 3,
        "backoff": 2.0, "checkpoint_every": 50, "compression": "zstd", "nllb_chunk_tokens": 400,
    },
    "tenure": {"batch_size": 25, "rate_limit_delay": 0.1, "chunk_size": 100, "dataset_candidates": ["data/corpus.parquet", "data/_build/corpus_merged.parquet"], "cleaned_root": "data/cleaned", "tenure_window": 1, "min_confidence": ["high", "medium"]},
    "audio": {"backend": "faster-whisper", "model": "large-v3", "device": "auto", "compute_type": "auto", "language": None, "delete_audio_after_transcribe": False, "rate_limit_delay": 0.0, "pause_every": 0, "pause_seconds": 0.0, "max_consecutive_failures": 25, "save_every": 5},
}
#: Verdicts of rows that go into the merged corpus; None is all but errors.
KEEP = {"accepted": ["accepted"], "speakers": ["accepted", "rejected_foreign", "rejected_non_leader"], "all": None}


def settings(stage: str, path: str | None = None, default: str | None = None, **given) -> dict:
    """The stage's settings: what is ``given``, over the file's (YAML), over the defaults.

    The file is the one at ``path`` if it is there, else at ``default``, else
    none.  A name that no setting has, or a value of another kind, is refused.
    """
    out = {k: list(v) if isinstance(v, list) else v for k, v in SETTINGS[stage].items()}
    said = {}
    for place in (path, default):
        if place and os.path.exists(place):
            import yaml

            with open(place, encoding="utf-8") as f:
                said = yaml.safe_load(f) or {}
            break
    for name, value in {**said, **given}.items():
        if name not in out:
            raise ValueError(f"{stage} has no setting {name}")
        kind = type(SETTINGS[stage][name])
        if SETTINGS[stage][name] is not None and not isinstance(value, (int, float) if kind is float else kind):
            raise ValueError(f"{stage}.{name} must be {kind.__name__}, not {value!r}")
        out[name] = value
    return out
