"""Overlays that people write, as YAML: corrections, and keys to keep out. Small by nature, so read on the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.curation import OVERRIDE, CurationError, check

FILES = {"mcp": "mcp.yaml", "skill": "skills.yaml"}
DENIED = "denylist.yaml"


class OverlayError(ValueError):
    """An overlay that can't be taken as it stands."""


def load_yaml(text: str):
    """YAML in which no mapping repeats a key."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        out = {}
        for k, v in node.value:
            key = loader.construct_object(k, deep=deep)
            if key in out:
                raise OverlayError(f"repeated key {key!r}")
            out[key] = loader.construct_object(v, deep=True)
        return out

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Loader)


def _entries(text: str, what: str) -> list[dict]:
    held = load_yaml(text)
    held = {} if held is None else held
    if not isinstance(held, dict) or not isinstance(held.get("entries") or [], list) or not all(isinstance(e, dict) for e in held.get("entries") or []):
        raise OverlayError(f"{what} is no mapping with a list of entries")
    return held.get("entries") or []


def _said(e: dict, kind: str | None) -> dict:
    """One correction; kind: of its file, which a correction can't leave."""
    key = e.get("key")
    if not isinstance(key, str) or not key.strip():
        raise OverlayError("a correction needs a key")
    own = e.get("kind", kind or key.split(":", 1)[0])
    if kind is not None and own != kind:
        raise OverlayError(f"{key!r} of kind {own!r} is in the file of {kind!r}")
    aliases, fields = e.get("aliases") or [], e.get("fields") or {}
    if not isinstance(aliases, list) or not all(isinstance(a, str) for a in aliases):
        raise OverlayError(f"{key!r} has aliases that are no list of keys")
    if not isinstance(fields, dict):
        raise OverlayError(f"{key!r} has fields that are no mapping")
    return {"key": key.strip(), "kind": own, "aliases": sorted(set(aliases)), "fields": {k: json.dumps(v, ensure_ascii=False) for k, v in fields.items()}}


def overrides(spark: SparkSession, *texts: str, kinds: tuple[str | None, ...] | None = None) -> DataFrame:
    """(key, kind, aliases, fields) of the entries of correction files, values as JSON; no key twice in all of them.

    kinds: what each file may correct; none for either.
    """
    try:
        rows = check([_said(e, kind) for text, kind in zip(texts, kinds or [None] * len(texts), strict=True) for e in _entries(text, "a correction file")])
    except CurationError as e:
        raise OverlayError(str(e)) from e
    return spark.createDataFrame([(r["key"], r["kind"], r["aliases"], r["fields"]) for r in rows], OVERRIDE)


def denials(spark: SparkSession, text: str) -> DataFrame:
    """(key, reason) of a denial file; a reason has 8 to 300 characters."""
    rows = [(e.get("key"), e.get("reason")) for e in _entries(text, "a denial file")]
    for key, reason in rows:
        if not isinstance(key, str) or not isinstance(reason, str) or not 8 <= len(reason) <= 300:
            raise OverlayError(f"{key!r} needs a reason of 8 to 300 characters")
    if len({k for k, _ in rows}) < len(rows):
        raise OverlayError("a key is denied twice")
    return spark.createDataFrame(rows, "key string, reason string")


def folder(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame]:
    """(overrides, denials) of a folder's files; one that isn't there says nothing."""
    from pyarrow import fs

    def text(name: str) -> str:
        files, path = fs.FileSystem.from_uri(f"{at}/{name}")
        if files.get_file_info(path).type != fs.FileType.File:
            return ""
        with files.open_input_stream(path) as f:
            return f.read().decode()

    return overrides(spark, *[text(n) for n in FILES.values()], kinds=tuple(FILES)), denials(spark, text(DENIED))
