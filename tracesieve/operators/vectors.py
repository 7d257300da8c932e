"""Nearest priors of vectors, block by block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block; a task holds two blocks and the product of at most _SLICE rows with one.
BLOCK, _SLICE = 8_192, 512


def novel(nearest: Column, limit: float) -> Column:
    """True below the limit; an item without a prior is novel."""
    return F.coalesce(nearest < limit, F.lit(True))


def _units(vectors: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: places and unit vectors; zeros for zero and non-finite ones, no length for nulls."""
    lists = [np.zeros(0) if v is None else np.asarray(v, dtype=np.float64) for v in vectors]
    lengths = np.array([len(v) for v in lists])
    out = {}
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        m = np.stack([lists[i] for i in at])
        m[~np.isfinite(m).all(axis=1)] = 0
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        out[int(size)] = at, np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    return out


def _best(items: pd.DataFrame, priors: pd.DataFrame) -> pd.DataFrame:
    best = np.full(len(items), -np.inf)
    ids, own = items["id"].to_numpy(), priors["id"].to_numpy()
    of_priors = _units(priors["v"])
    for size, (rows, m) in _units(items["v"]).items():
        for other, (at, p) in of_priors.items():
            for i in range(0, len(rows), _SLICE):
                part = rows[i : i + _SLICE]
                near = m[i : i + _SLICE] @ p.T if other == size else np.zeros((len(part), len(at)))
                near[ids[part][:, None] == own[at][None, :]] = -np.inf
                best[part] = np.maximum(best[part], near.max(axis=1))
    return pd.DataFrame({"id": ids, "nearest": best})[best > -np.inf]


def nearest_prior(items: DataFrame, priors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, nearest): the greatest cosine of each item (id, v) with the priors (id, v) of another
    id, null if there are none; ids are unique and not null on each side. Vectors that are null,
    zero, not finite or of another length have cosine 0, as in functions.text.cosine.

    The maximum is exact, so every item meets every prior: blocks of both sides are paired, each
    pair is a task's matrix product, and only an item's best of each block is shuffled again."""
    blocks = [max(1, -(-df.count() // block)) for df in (items, priors)]
    place = lambda k: F.pmod(F.xxhash64("id"), F.lit(blocks[k])).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(blocks[k] - 1)))
    left = items.select("id", "v", place(0).alias("i"), every(1).alias("j"))
    right = priors.select("id", "v", every(0).alias("i"), place(1).alias("j"))
    kind = items.schema["id"].dataType.simpleString()
    best = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(_best, f"id {kind}, nearest double")
    return items.select("id").join(best.groupBy("id").agg(F.max("nearest").alias("nearest")), "id", "left")
