"""Settings from an INI file: Spark's own, access to stores, the model service and paths."""

from __future__ import annotations

import configparser
import os
from dataclasses import dataclass, field

#: Keys of [store] and what they set; without keys Hadoop's own providers are asked.
STORE = {
    "endpoint": "spark.hadoop.fs.s3a.endpoint",
    "region": "spark.hadoop.fs.s3a.endpoint.region",
    "access_key": "spark.hadoop.fs.s3a.access.key",
    "secret_key": "spark.hadoop.fs.s3a.secret.key",
    "session_token": "spark.hadoop.fs.s3a.session.token",
    "credentials": "spark.hadoop.fs.s3a.aws.credentials.provider",
}


@dataclass(frozen=True)
class Settings:
    spark: dict[str, str] = field(default_factory=dict)
    embedding: dict[str, str] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)


def load(path: str | None) -> Settings:
    """Sections spark, store, embedding and paths; ``${NAME}`` in a value is taken from the environment."""
    parser = configparser.ConfigParser(interpolation=None)
    parser.optionxform = str  # names of Spark's settings have capitals
    if path is not None and not parser.read(path, encoding="utf-8"):
        raise FileNotFoundError(path)
    section = lambda name: {k: os.path.expandvars(v) for k, v in (parser[name].items() if parser.has_section(name) else ())}
    store = section("store")
    if unknown := store.keys() - STORE.keys():
        raise ValueError(f"unknown store setting: {min(unknown)}")
    if ("access_key" in store) != ("secret_key" in store):
        raise ValueError("access_key and secret_key go together")
    return Settings(section("spark") | {STORE[k]: v for k, v in store.items()}, section("embedding"), section("paths"))
