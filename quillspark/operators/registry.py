"""The registry of clusters: which entry each group of items goes to, as if groups came one after another."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.vectors import normalized
from quillspark.operators.cells import Cells
from quillspark.operators.graph import connected_components
from quillspark.operators.vectors import PROBES, pairs_above
from quillspark.runtime import Stash, ship


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v)
    return v / n if n > 0 else v


def _taken_in(least: float):
    """The groups of a component in order, each to the entry nearest to it as it stands then, or to a new one."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        old = pdf[pdf["id"] < 0].sort_values("id", ascending=False)
        names = [(True, -i - 1) for i in old["id"].tolist()]
        spots = [_unit(np.asarray(v, float)) for v in old["vector"]]
        weight = old["weight"].astype(float).tolist()
        out = []
        groups = pdf[pdf["id"] >= 0].sort_values(["position", "id"])
        for i, vector, n in zip(groups["id"].tolist(), groups["vector"], groups["weight"].astype(float)):
            total = np.asarray(vector, float)
            near = np.array(spots) @ _unit(total) if spots else np.zeros(0)
            at = int(near.argmax()) if len(near) else -1
            if at >= 0 and near[at] >= least:
                spots[at] = _unit((spots[at] * weight[at] + total) / (weight[at] + n))
                weight[at] += 1
                out.append((i, names[at][1] if names[at][0] else None, None if names[at][0] else names[at][1], float(near[at])))
            else:
                spots.append(_unit(total))
                weight.append(1.0)
                names.append((False, i))
                out.append((i, None, i, float(near[at]) if at >= 0 else None))
        return pd.DataFrame(out, columns=["id", "entry", "leader", "similarity"]).astype({"id": "int64", "entry": "Int64", "leader": "Int64", "similarity": "float64"})

    return run


def registry_matches(groups: DataFrame, registry: DataFrame, least: float = 0.90, cells: Cells | None = None, probes: int = PROBES) -> DataFrame:
    """What becomes of each group: ``id, action`` (``reinforce`` or ``insert``), ``registry_id, similarity``.

    ``groups`` hold ``id`` (not negative), ``position`` (their order), ``n, total``;
    ``registry`` ``id, centroid`` and ``occurrence_count`` (else 1).  A group goes to the entry whose centroid is
    nearest, if the cosine reaches ``least``, and moves it; a later group sees that, and
    entries made by earlier groups.  A new entry's id is the group's plus one plus the
    largest id there is.  Entries without a centroid match nothing.

    Groups and entries that no chain of cosines of ``least ** 2`` or more connects never
    have a say in each other: a centroid moves along the arc to a group within ``least``
    of it, and if both ends of such an arc are at less than ``least ** 2``, or the centroid
    at less than ``least`` and the group at less than ``least ** 2``, from a third
    vector, then so is, at less than ``least``, all of the arc.  So each connected set
    is taken in order by a task of its own.
    """
    spark = groups.sparkSession
    ship(spark)
    stash = Stash(spark, "matches")
    mine = groups.select("id", F.col("position").cast("long").alias("position"), F.transform("total", lambda x: x.cast("double")).alias("vector"), F.col("n").cast("double").alias("weight"))
    entries = registry.where(F.col("centroid").isNotNull()).select((-F.col("id") - 1).alias("id"), F.lit(None).cast("long").alias("position"), F.transform("centroid", lambda x: x.cast("double")).alias("vector"), (F.col("occurrence_count").cast("double") if "occurrence_count" in registry.columns else F.lit(1.0)).alias("weight"))
    nodes = stash.put(mine.unionByName(entries))
    near = pairs_above(nodes.select("id", normalized(F.col("vector")).alias("embedding")), least * least - 1e-9, cells=cells, probes=probes)
    sets = connected_components(near.where("id >= 0 or neighbour >= 0").where("id < neighbour"), "id", "neighbour")
    linked = nodes.join(sets.withColumnRenamed("node", "id"), "id")
    taken = linked.groupBy("component").applyInPandas(_taken_in(least), "id long, entry long, leader long, similarity double")
    alone = mine.join(sets.select(F.col("node").alias("id")), "id", "left_anti").select("id", F.lit(None).cast("long").alias("entry"), F.col("id").alias("leader"), F.lit(None).cast("double").alias("similarity"))
    first = registry.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("first")).scalar()
    every = stash.put(taken.unionByName(alone)).withColumn("registry_id", F.coalesce("entry", first + 1 + F.col("leader")))
    return every.select("id", F.when(F.col("leader") == F.col("id"), "insert").otherwise("reinforce").alias("action"), "registry_id", "similarity")


def registry_centroids(groups: DataFrame, registry: DataFrame) -> DataFrame:
    """Centroid and occurrences of the entries that groups went to: ``target, centroid, occurrences, taken``.

    ``groups`` hold ``target``, ``turn, group`` (their order, the entry's maker first), ``n, total``.
    An entry's old centroid weighs as many occurrences as it stands for.
    """
    ship(groups.sparkSession)

    def run(key: tuple, mine: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values(["turn", "group"])
        c, k = (np.asarray(old["centroid"].iloc[0], float), float(old["occurrence_count"].iloc[0])) if len(old) else (None, 0.0)
        for total, n in zip(mine["total"], mine["n"].astype(float)):
            total = np.asarray(total, float)
            c = _unit(total / n) if c is None else _unit((c * k + total) / (k + n))
            k += 1
        return pd.DataFrame({"target": key[0], "centroid": [c], "occurrences": [int(k)], "taken": [len(mine)]})

    old = registry.where(F.col("centroid").isNotNull()).select(F.col("id").alias("entry"), "centroid", "occurrence_count").join(groups.select(F.col("target").alias("entry")).distinct(), "entry", "left_semi")
    return groups.select("target", "turn", "group", "n", "total").groupBy("target").cogroup(old.groupBy("entry")).applyInPandas(run, "target long, centroid array<double>, occurrences int, taken int")
