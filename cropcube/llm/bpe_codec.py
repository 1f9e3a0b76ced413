"""BPE encoding and decoding of whole texts (speculate and verify, see bytebpe)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropcube.llm.bytebpe import default_path, encoder
from cropcube.llm.common import as_bytes, slices

SLICE_BYTES = 4 << 20


def encode(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """Token ids of every text, as the tokenizers library gives them without added tokens.

    Returns ``key``, ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned
    32-bit integers); with ``decoded``, also the text that these ids decode to, made in
    the same pass.  Strings of special tokens inside a text become those tokens.  A null
    text counts as empty and gives no tokens; a null or repeated key is kept, one row out
    for each row in; other columns are not read.  No shuffle.
    """
    path = vocabulary or default_path()

    def run(batches):
        enc = encoder(path)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found: list[list[np.ndarray]] = [[] for _ in texts]
            for row, ids in enc.encode(texts):
                found[row].append(ids)
            joined = [np.concatenate(f) if len(f) > 1 else f[0] for f in found]
            out = [part.column("k"), pa.array([len(i) for i in joined], pa.int64()),
                   pa.array([i.astype("<u4").tobytes() for i in joined], pa.binary())]
            if decoded:
                out.append(pa.array([enc.decode(i) for i in joined], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["k", "n_tokens", "ids", "decoded"][:len(out)])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"k {kind}, n_tokens long, ids binary" + ", decoded string" * decoded
    out = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text"))
    return out.mapInArrow(run, schema).withColumnRenamed("k", key)


def decode(tokens: DataFrame, vocabulary: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text of a binary column of little-endian 32-bit ids.

    Special tokens are kept as their strings; bytes that form no valid UTF-8 are
    replaced.  Null ids decode to an empty text.  The other columns stay.
    """
    path = vocabulary or default_path()

    def run(batches):
        enc = encoder(path)
        for part in slices(batches, ids, SLICE_BYTES):
            raw, off = as_bytes(part.column(ids))
            text = [enc.decode(raw[a:b].view("<u4").astype(np.int64)).decode()
                    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], [*part.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields)
    return tokens.mapInArrow(run, f"{fields}, `{out}` string")
