"""Documents into containers of fixed capacity: vector bin packing by the dot-product heuristic.

A container has three limits: tokens, segments (documents) and loss-bearing tokens (those after a document's first line, which is the
prompt). All hold for every container. A piece with more loss-bearing tokens than a container may have isn't split for that: the first of them are
masked, context like a prompt. Documents are spread by a hash over shards of about `shard_docs`, each packed by itself in one task, so the work grows
with the documents and no task with the corpus; each shard leaves one container or two unfilled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents packed together. A shard's last container stays part empty, so the loss of room is about half a container a shard.
SHARD_DOCS = 8192
#: Limits besides the tokens: loss-bearing tokens as a share of the capacity, and tokens of capacity for each segment allowed.
LOSS_SHARE, TOKENS_A_SEGMENT = 0.95, 64
_SCHEMA = "container string, bin string, doc_id bigint, piece_no int, first_token bigint, tokens bigint, loss_tokens bigint"


def dot_product_pack(items: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Bin number of each item (rows: sizes in each dimension; dimension 0 is the capacity proper) under all limits at once.

    One bin is open at a time. Into it goes, of the items that fit in every dimension, the one whose sizes have the largest dot
    product with the room left, each dimension weighted by the total demand for it. No item may be beyond a limit by
    itself (ValueError). Equal items are alike; ties go to the first.
    """
    n = len(items)
    bins = np.full(n, -1)
    if n == 0:
        return bins
    scaled = items / limits
    weight = scaled.sum(0) / max(scaled.sum(), 1e-12)
    order = np.lexsort(tuple(-scaled[:, k] for k in range(items.shape[1] - 1, -1, -1)))
    scaled, number = scaled[order], order
    if (scaled > 1 + 1e-9).any():
        raise ValueError("an item is larger than a bin")
    opened = 0
    # One array a dimension: comparing columns is several times as fast as comparing short rows.
    columns = [np.ascontiguousarray(c) for c in scaled.T]
    falling = -columns[0]
    left = np.ones(len(number), bool)
    first = 0  # all before it are placed
    while first < len(number):
        room = [1.0] * len(columns)
        k = first
        while k >= 0:
            left[k] = False
            bins[number[k]] = opened
            room = [r - c[k] for r, c in zip(room, columns)]
            while first < len(number) and not left[first]:
                first += 1
            # Sorted by the first dimension: what is too large in it needn't be looked at.
            start = max(first, int(np.searchsorted(falling, -room[0] - 1e-9)))
            fits = left[start:].copy()
            for r, c in zip(room[1:], columns[1:]):
                fits &= c[start:] <= r + 1e-9
            found = np.flatnonzero(fits)
            if not len(found):
                break
            value = sum(w * r * c[start:][found] for w, r, c in zip(weight, room, columns))
            k = start + int(found[value.argmax()])
        opened += 1
    return bins


def pack_documents(sizes: DataFrame, capacities: DataFrame, shard_docs: int = SHARD_DOCS, loss_share: float = LOSS_SHARE, tokens_a_segment: int = TOKENS_A_SEGMENT) -> DataFrame:
    """(container, bin, doc_id, piece_no, first_token, tokens, loss_tokens): where each document goes, for each row of capacities.

    sizes: doc_id, tokens, head_tokens (see token_counts). capacities: container, capacity_tokens, a table of settings (at most 1000
    rows; NULL or non-positive capacities are left out). A document is whole (piece_no 1) unless it exceeds the capacity: then full pieces
    fill containers of their own and the rest is packed like a document. Every container keeps all limits: capacity tokens,
    loss_share * capacity loss-bearing tokens, capacity / tokens_a_segment segments (each at least 1). loss_tokens are those
    that bear loss after masking. Documents without tokens take no room: bin is NULL, piece_no 0. Repeated rows are packed as often as they
    occur, spread over the shards like others. Empty tables give no rows. sizes is read twice: hand it over stored.
    """
    rows = capacities.where(F.col("container").isNotNull() & (F.col("capacity_tokens") > 0)).select("container", F.col("capacity_tokens").cast("long")).distinct().limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("capacities is a table of settings; it has more than 1000 rows")
    if not rows:
        return sizes.sparkSession.createDataFrame([], _SCHEMA)
    settings = F.array(*(F.struct(F.lit(r[0]).alias("container"), F.lit(r[1]).alias("capacity")) for r in sorted(rows)))
    shards = max(1, -(-sizes.count() // shard_docs))
    tokens = F.coalesce("tokens", F.lit(0)).cast("long")
    # By id and place of the row: rows of one id don't make a shard of their own.
    spread = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(shards))
    each = sizes.select(F.col("doc_id").cast("bigint").alias("doc_id"), tokens.alias("size"), F.coalesce("head_tokens", F.lit(0)).cast("long").alias("head"), spread.alias("shard"), F.explode(settings).alias("s")).select("doc_id", "size", "head", "shard", "s.*")
    most_loss = F.greatest(F.floor(F.col("capacity") * loss_share), F.lit(1)).cast("long")
    full = F.when(F.col("size") > F.col("capacity"), F.floor(F.col("size") / F.col("capacity"))).otherwise(0).cast("long")
    each = each.withColumn("full", full)
    loss = lambda start, end: F.least(F.greatest(end - F.greatest(start, F.col("head")), F.lit(0).cast("long")), most_loss)
    start = (F.col("piece_no") - 1) * F.col("capacity")
    whole = (
        each.where(F.col("full") > 0)
        .withColumn("piece_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("full"))))
        .select("container", F.concat_ws("/", "container", F.lit("doc"), "doc_id", "piece_no").alias("bin"), "doc_id", F.col("piece_no").cast("int").alias("piece_no"), start.alias("first_token"), F.col("capacity").alias("tokens"), loss(start, start + F.col("capacity")).alias("loss_tokens"))
    )
    begin = F.col("full") * F.col("capacity")
    rest = each.where(F.col("size") > begin).select(
        "container", "capacity", "shard", "doc_id", (F.col("full") + 1).cast("int").alias("piece_no"), begin.alias("first_token"), (F.col("size") - begin).alias("tokens"), loss(begin, F.col("size")).alias("loss_tokens")
    )
    empty = each.where(F.col("size") <= 0).select("container", F.lit(None).cast("string").alias("bin"), "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("first_token"), F.lit(0).cast("long").alias("tokens"), F.lit(0).cast("long").alias("loss_tokens"))

    def packed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        container, capacity, shard = key
        pdf = pdf.sort_values(["tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable")
        sizes_ = np.column_stack((pdf["tokens"], np.ones(len(pdf)), pdf["loss_tokens"])).astype(float)
        bins = dot_product_pack(sizes_, np.array([capacity, max(1, capacity // tokens_a_segment), max(1, int(capacity * loss_share))]))
        return pdf.assign(bin=[f"{container}/{shard}/{b}" for b in bins])[["container", "bin", "doc_id", "piece_no", "first_token", "tokens", "loss_tokens"]]

    return rest.groupBy("container", "capacity", "shard").applyInPandas(packed, _SCHEMA).unionByName(whole).unionByName(empty)


def packing_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(container, capacity_tokens, bins, documents, pieces, tokens, fill): how full the containers are."""
    used = packed.where(F.col("bin").isNotNull())
    # One row a container and bin first, so that counting distinct bins isn't a shuffle of all pieces to one task.
    bins = used.groupBy("container", "bin").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"), F.sum((F.col("piece_no") == 1).cast("long")).alias("documents"))
    total = bins.groupBy("container").agg(F.count(F.lit(1)).alias("bins"), F.sum("documents").alias("documents"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"))
    return total.join(F.broadcast(capacities.select("container", F.col("capacity_tokens").cast("long").alias("capacity_tokens")).distinct()), "container").withColumn("fill", F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")))
