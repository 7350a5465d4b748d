"""BPE encoding and decoding of whole documents with a byte-level vocabulary, as digests for each document.

Defined results: null and empty text have no tokens and decode to empty text; the vocabulary's special token inside
a text is encoded as that token, as the library does by default; repeated rows give the same.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import table
from tessera.llm.wordtable import decode, encode


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Tokens, hash of ids and hash of the text decoded from them, for each document."""

    def then(encoded: pa.Table) -> pa.Table:
        ids = encoded.column("ids").to_pylist()
        return pa.table({
            "doc_id": encoded.column("doc_id"),
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(decode(x, path)).hexdigest() for x in ids], pa.string()),
        })

    return encode(docs, path, then=(then, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or vocabulary("byte_bpe_50k.json")
    return digest(table(spark, sf_dir, "documents"), path)
