"""Settings of the batch, from a mapping such as the environment; nothing is read or raised on import."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    input_dir: str = "input"
    processed_dir: str = "processed"
    failed_dir: str = "failed"
    output_dir: str = "output"
    store_dir: str = "store"
    mock_extractor: bool = False
    smtp_host: str | None = None
    smtp_port: int = 587
    smtp_user: str | None = None
    smtp_password: str | None = None
    mail_from: str | None = None
    mail_to: str | None = None

    @classmethod
    def from_mapping(cls, values: Mapping[str, str] | None = None) -> Config:
        values = os.environ if values is None else values
        found = {}
        for name, field in cls.__dataclass_fields__.items():
            raw = values.get(name.upper())
            if raw is None or raw == "":
                continue
            found[name] = raw.strip().lower() in ("1", "true", "yes") if field.type == "bool" else int(raw) if field.type == "int" else raw
        return cls(**found)

    def missing(self, *names: str) -> list[str]:
        """Which of the settings that a caller needs are not set."""
        return [n for n in names if getattr(self, n) in (None, "")]
