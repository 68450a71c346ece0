"""SimHash near-dedup (operator 8).

Method: a 64-bit SimHash over word shingles; fingerprints that differ in at most ``radius``
bits are linked. Pigeonhole: the fingerprint is cut into ``blocks`` blocks; two fingerprints
within ``radius`` agree on at least ``blocks - radius`` of them, so every choice of that many
blocks is a join key and every linked pair shares one of the keys. Members of a key's bucket
are compared by Hamming distance (``buckets``), links become components (``components``).

Texts are lower-cased in A-Z only, words are runs without ASCII white space, shingles keep
repeats and are joined by one space; fewer words than a shingle make one shingle of all words.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any
other; equal fingerprints are always linked; very long texts are hashed whole; null ids get a
fingerprint, take no part in links and have no component; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.buckets import UNIT, forest, meets, units
from popweave.llm.common import prepare, read, slices, starts, whole_groups
from popweave.llm.components import components
from popweave.session import materialize

SEED = 42


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned SimHash of one UTF-8 text."""
    from xxhash import xxh64_intdigest as xxh

    words = text.lower().split()  # bytes: A-Z only; splits on 0x09-0x0D and space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = [0, *ends[:-width].tolist()]
    end = (ends[width - 1:] - 1).tolist()
    h = np.array([xxh(joined[i:j], SEED) for i, j in zip(begin, end)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 14):
        part = h[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                fp = np.array([fingerprint(t or b"", width) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, fp long")


def block_keys(fp: Column, blocks: int, radius: int) -> Column:
    """One key per choice of ``blocks - radius`` blocks: the chosen bits, hashed with the choice."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(signed(sum(masks[i] for i in chosen)))))
            for n, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    return F.array(*keys)


def links(reps: DataFrame, blocks: int = 7, radius: int = 4, chunk: int = 2048) -> DataFrame:
    """Links (a, b) between the ``rep`` ids of distinct fingerprints within ``radius``: all
    links inside a unit up to a spanning forest, which leaves the components the same."""
    def run(batches):
        for table in whole_groups(batches, UNIT):
            at = starts(table, UNIT).tolist()
            reps_, fps = table.column("rep").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
            own, ui, uj = (table.column(c).to_numpy() for c in ("own", "ui", "uj"))
            a, b = [], []
            for i, j in zip(at, [*at[1:], table.num_rows]):
                near = np.bitwise_count(fps[i:j, None] ^ fps[None, i:j]) <= radius
                if (ours := meets(own[i:j], ui[i], uj[i])) is not None:
                    near &= ours
                for x, y in forest(near):
                    a.append(reps_[i + x])
                    b.append(reps_[i + y])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keyed = reps.select("rep", "fp", F.explode(block_keys(F.col("fp"), blocks, radius)).alias("key"))
    return units(keyed, "rep", chunk).select("rep", "fp", "own", *UNIT).mapInArrow(run, "a long, b long")


def classify(docs: DataFrame, width: int = 4, radius: int = 4, blocks: int = 7,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``fp``, ``component_id`` (smallest id reachable by links)."""
    rows = materialize(fingerprints(docs, width, id_col, text_col), "simhash")
    reps = materialize(rows.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    groups = components(links(reps, blocks, radius))
    # both grow with the corpus: merged at any size, never broadcast through the driver
    label = (reps.join(groups.hint("merge"), reps.rep == groups.node, "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return (rows.join(label.hint("merge"), "fp", "left")
            .select(F.col("id").alias(id_col), "fp",
                    F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")))


def dedup(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """Keep the documents that are their group's smallest id (rows without id stay; of
    repeated rows with one id, all or none stay); all columns of ``docs``."""
    gone = (classify(docs, width, radius).filter("component_id IS NOT NULL AND doc_id != component_id")
            .select(F.col("doc_id").alias("_gone")).distinct())
    # copies are a share of the corpus, so this is a merge join at any size
    return docs.join(gone.hint("merge"), docs.doc_id == gone._gone, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return classify(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
