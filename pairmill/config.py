"""Settings of the jobs. Defaults apply when neither an argument nor the environment sets one."""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field, fields


def new_run_id() -> str:
    """Run id from the driver's clock; every row of a run carries it as a literal."""
    return time.strftime("%Y%m%d-%H%M%S")


@dataclass(frozen=True)
class ChatTemplate:
    """One user turn followed by the marker that starts the answer.

    Preparation, generation and the context check share one template, so the text a model was
    trained on is the text it is asked with.
    """

    prefix: str = "<|im_start|>user\n"
    suffix: str = "<|im_end|>\n<|im_start|>assistant\n"


class _FromEnv:
    """Builds a settings class from environment variables named after its fields."""

    @classmethod
    def from_env(cls, **overrides):
        values = {}
        for f in fields(cls):
            text = os.environ.get(f.name.upper())
            if text is None or f.name in overrides:
                continue
            values[f.name] = {"int": int, "float": float}.get(f.type, str)(text)
        return cls(**{**values, **overrides})


def _shared(path: str):
    """Default place of a folder below the storage all nodes share."""
    return field(
        default_factory=lambda: f"{os.environ.get('SHARED_DIR', '/mnt/cluster_storage')}/{path}"
    )


# The default settings of the three jobs and of the acceptance checks.

@dataclass(frozen=True)
class PrepConfig(_FromEnv):
    raw_dir: str = _shared("data/raw")
    tokenized_root: str = _shared("data/tokenized")
    run_id: str = field(default_factory=new_run_id)
    base_model: str = "Qwen/Qwen2.5-0.5B-Instruct"
    max_len: int = 1024
    eval_rows: int = 32
    eval_max_fraction: float = 0.25
    min_answer_tokens: int = 16
    raw_format: str = "json"
    # Tasks that tokenize; 0 keeps the partitions of the deduplicated pairs.
    tokenize_partitions: int = 0


@dataclass(frozen=True)
class TrainConfig(_FromEnv):
    tokenized_dir: str = _shared("data/tokenized")
    model_root: str = _shared("models")
    run_id: str = field(default_factory=new_run_id)
    base_model: str = "Qwen/Qwen2.5-0.5B-Instruct"
    parallel_strategy: str = "ddp"
    num_workers: int = 2
    epochs: int = 2
    batch_size: int = 4
    lr: float = 1e-5
    seed: int = 42


@dataclass(frozen=True)
class GenConfig(_FromEnv):
    model_path: str = _shared("models")
    eval_path: str = _shared("data/tokenized")
    output_root: str = _shared("outputs/batch")
    run_id: str = field(default_factory=new_run_id)
    accept_sample: int = 0
    max_empty_fraction: float = 0.0
    concurrency: int = 0
    batch_size: int = 32
    max_model_len: int = 2048
    max_tokens: int = 256


@dataclass(frozen=True)
class AuditConfig(_FromEnv):
    """Tables of the audit jobs, and the limits of the acceptance checks.

    ``min_stream_span`` and ``curl_max_time`` are seconds.
    """

    log_path: str = ""
    report_path: str = ""
    model_id: str = ""
    min_stream_span: float = 0.15
    curl_max_time: int = 180
    job_timeout: int = 3600
    max_failing: int = 0


# Shortest time from the first to the last content chunk, and the limit of one transfer.
MIN_STREAM_SPAN_US = 150_000
TRANSFER_LIMIT_S = 180
# Label value that the loss ignores.
IGNORED_LABEL = -100
