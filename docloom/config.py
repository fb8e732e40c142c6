"""Configuration from the environment: everything has a default, nothing secret is needed for local work."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    """Settings of the load and search jobs. ``DOCLOOM_<NAME>`` in the environment overrides a default.

    ``table`` is a database table where ``jdbc_url`` is set, else a Parquet folder; ``collection`` is a folder. Without
    ``embedding_url`` vectors come from the hashing stand-in.
    """

    table: str = "documents"
    collection: str = "passages"
    vector_size: int = 1536
    chunk_words: int = 600
    overlap: int = 1
    page_rows: int = 100
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str | None = None
    embedding_url: str | None = None
    embedding_model: str = "default"
    embedding_token: str | None = None

    @classmethod
    def read(cls, environment: Mapping[str, str] | None = None) -> Config:
        found = os.environ if environment is None else environment
        kinds = {"int": int, "str": str, "str | None": str}
        given = {f.name: kinds[f.type](found[key]) for f in fields(cls) if (key := f"DOCLOOM_{f.name.upper()}") in found}
        return cls(**given)

    def required(self, *names: str) -> Config:
        """Itself, if all the named settings have a value."""
        if missing := [n for n in names if getattr(self, n) in (None, "")]:
            raise ValueError(f"settings without a value: {', '.join(missing)}")
        return self
