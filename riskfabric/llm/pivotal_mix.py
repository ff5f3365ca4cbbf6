"""Mixing sources to target weights by pivotal dependent rounding.

*Targets.* Sources in code point order (null last) take the weights in turn and share the
corpus' words by weight. A target stops at ``most`` times its source's size; what it leaves is
shared again by weight. The level at which no target is above its limit comes from a few
aggregates over the sources, one row each.

*Rounding.* A document of a source with target / size = f gets floor(f) copies and keeps the
fraction of one more. Fractions are held as words in integers of 1 / ``UNIT`` word. Two
documents are paired: a random one gains from the other as many words as bring one of the two
to no copy or to a whole one, with the odds that leave both expectations as they were. The
other, if it is still fractional, goes on. Equal rows are one unit with a count, of which at
most one row is fractional.

*Tree.* Units are dealt by a hash over leaves of about ``LEAF`` units a source, however large
the source; each leaf rounds its units and passes at most one fractional one on, ``FAN`` nodes
to a node of the next level, until a source has a single node. The one fraction that is left a
source is taken as a part of that document (its first words), so that a source's words meet its
target to the word.

The hash and the random numbers come from the rows and ``seed`` alone: partitions, file order
and tasks that run again change nothing.

Defined results: a null or empty text has size 0 and takes 0 words; the null source is a source
of its own; a null identifier is one like others; each repeated row is rounded (equal rows may
get different numbers of copies, which of them is not defined); a source without words has the
target 0; an empty table gives no rows. Very long texts are counted whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfabric.llm.common import scratch_table, ship_package

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
MOST = 3
#: Parts of a word that fractions are held in.
UNIT = 1 << 20
#: Units a leaf, and nodes that one node of the next level joins.
LEAF, FAN = 512, 512
#: Equal rows that one task writes in a row.
CHUNK = 100_000
SEED = 11

_NODE = "source string, doc_id long, size long, row_hash long, rows long, source_size long, target double, base int, key long, leaf long, ups long, mass long"
_COLUMNS = [x.split()[0] for x in _NODE.split(", ")]


def pivot(mass: np.ndarray, room: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Masses after pairing: each is 0 or its ``room`` but for one at most; their sum stays."""
    mass = mass.copy()
    alive = np.flatnonzero((mass > 0) & (mass < room))
    while len(alive) > 1:
        half = len(alive) // 2
        a, b = alive[0 : 2 * half : 2], alive[1 : 2 * half : 2]
        up = np.minimum(room[a] - mass[a], mass[b])  # what a can take from b
        down = np.minimum(mass[a], room[b] - mass[b])  # what b can take from a
        shift = np.where(rng.random(half) * (up + down) < down, up, -down)
        mass[a] += shift
        mass[b] -= shift
        alive = alive[(mass[alive] > 0) & (mass[alive] < room[alive])]
    return mass


def _ordered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code point order from 0, null last; no task holds them all."""
    by = F.col("source").asc_nulls_last()
    placed = scratch_table(sources.repartitionByRange(by).withColumn("_part", F.spark_partition_id()), "mix_sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(by))
    return placed.join(parts, "_part").select(*sources.columns, (F.col("_before") + own - 1).alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, ...`` with ``target``: words that the mix should take of each source."""
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = scratch_table(_ordered(sources).withColumn("_weight", turn), "mix_weights")
    limit, weight = F.col("source_size") * F.lit(float(most)), F.col("_weight")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while total:
        # Sources at their limit under the last level; the others share the rest by weight.
        full = (limit <= weight * level) if held >= 0 else F.lit(False)
        at_limit, rest, n = s.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, weight)), F.count(F.when(full, 1))).first()
        if n == held:
            break
        level, held = ((total - (at_limit or 0.0)) / rest if rest else float("inf")), n
    return s.select(*sources.columns, F.least(limit, weight * level).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _hash(docs: DataFrame) -> Column:
    """A hash of all columns; maps can't be hashed but as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes])


def _round(level: int, seed: int):
    """Round one node's units; the one that stays fractional keeps a mass that isn't 0."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("size", "ascending"), ("row_hash", "ascending")])
        mass, room = table["mass"].to_numpy(), table["size"].to_numpy() * UNIT
        # Twin keys in other nodes don't matter: each node draws by its own first key.
        rng = np.random.default_rng([seed, level, int(table["key"][0].as_py()) & (2**64 - 1)])
        after = pivot(mass, room, rng)
        whole = (after == room) & (room > 0)
        ups = table["ups"].to_numpy() + whole
        table = table.set_column(table.schema.get_field_index("ups"), "ups", pa.array(ups, pa.int64()))
        return table.set_column(table.schema.get_field_index("mass"), "mass", pa.array(np.where(whole, 0, after), pa.int64()))

    return run


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Units (``_NODE``) with ``ups`` of their ``rows`` rounded up; a ``mass`` is a source's last fraction."""
    sized = docs.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), _hash(docs).alias("row_hash"),
    )
    units = scratch_table(sized.groupBy("source", "doc_id", "size", "row_hash").agg(F.count("*").alias("rows")), "mix_units")
    by_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units"))
    goal = scratch_table(targets(by_source, weights, most), "mix_targets")
    g = goal.select(F.col("source").alias("_source"), "source_size", "units", "target")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    parts = F.col("rows") * (F.col("_share") - F.col("base"))
    nodes = (
        units.join(g, _same(units["source"], g["_source"]))
        .withColumn("_share", share)
        .withColumn("base", F.floor("_share").cast("int"))
        .withColumn("ups", F.floor(parts).cast("long"))
        .withColumn("mass", F.round((parts - F.floor(parts)) * F.col("size") * F.lit(float(UNIT))).cast("long"))
        # A fraction that rounds to a whole copy is one.
        .withColumn("_whole", (F.col("mass") >= F.col("size") * UNIT) & (F.col("size") > 0))
        .withColumn("ups", F.col("ups") + F.col("_whole").cast("long"))
        .withColumn("mass", F.when(F.col("_whole"), F.lit(0)).otherwise(F.col("mass")))
        .withColumn("key", F.xxhash64(F.lit(seed), "source", "doc_id", "size", "row_hash"))
        .withColumn("leaf", F.pmod(F.col("key"), F.ceil(F.col("units") / LEAF)))
        .select(*_COLUMNS)
    )
    ship_package(docs.sparkSession)
    largest = goal.agg(F.max("units")).first()[0] or 0
    width, level, done, going = -(-largest // LEAF), 0, [], nodes
    while width > 0:
        out = scratch_table(going.groupBy("source", "leaf").applyInArrow(_round(level, seed), _NODE), f"mix_level_{level}")
        if width == 1:
            done.append(out)
            break
        # A node that stays alone passes its fraction through the same levels.
        done.append(out.where("mass = 0"))
        going = out.where("mass > 0").withColumn("leaf", F.expr(f"leaf div {FAN}"))
        width, level = -(-width // FAN), level + 1
    return reduce(DataFrame.unionByName, done) if done else nodes


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies (whole ones), part (words of one more), taken."""
    units = plan(docs, **options)
    part = F.round(F.col("mass") / UNIT).cast("long")
    one = F.when(F.col("mass") > 0, 1).otherwise(0).cast("long")
    kinds = F.array(
        F.struct((F.col("base") + 1).alias("copies"), F.lit(0).cast("long").alias("part"), F.col("ups").alias("n")),
        F.struct(F.col("base").alias("copies"), part.alias("part"), one.alias("n")),
        F.struct(F.col("base").alias("copies"), F.lit(0).cast("long").alias("part"), (F.col("rows") - F.col("ups") - one).alias("n")),
    )
    each = units.withColumn("_kind", F.explode(kinds)).select("doc_id", "source", "size", "row_hash", "source_size", "target", "_kind.*").where("n > 0")
    few = each.where(F.col("n") <= CHUNK)
    # A text that very many rows hold is written by many tasks.
    many = each.where(F.col("n") > CHUNK).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK).cast("long"))))
    many = many.withColumn("n", F.least(F.lit(CHUNK), F.col("n") - F.col("_from"))).repartition("doc_id", "row_hash", "_from").drop("_from")
    rows = few.unionByName(many).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    taken = F.col("copies") * F.col("size") + F.col("part")
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", "part", taken.alias("taken"))


def mixed(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as they are taken; a source's last one in part.

    Equal rows are joined by all columns' hash, identifier, source and size, so one of them stands for all.
    """
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    units = plan(docs, text_col=text_col, **options)
    total = F.col("base") * F.col("rows") + F.col("ups")
    part = F.round(F.col("mass") / UNIT).cast("int")
    want = units.select(
        F.col("row_hash").alias("_hash"), F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_words"), total.alias("_times"), part.alias("_part"),
    ).where("_times > 0 or _part > 0")
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        F.struct(*names).alias("_doc"), _hash(docs).alias("_hash2"), F.col(id_col).cast("long").alias("_id2"),
        F.col(source_col).cast("string").alias("_src2"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("_words2"),
    ).dropDuplicates(["_hash2", "_id2", "_src2", "_words2"])
    same = (F.col("_hash") == F.col("_hash2")) & _same(F.col("_id"), F.col("_id2")) & _same(F.col("_src"), F.col("_src2")) & (F.col("_words") == F.col("_words2"))
    found = keyed.join(want, same)
    first_words = F.array_join(F.slice(F.regexp_extract_all(F.col(f"_doc.{text_col}"), F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("_part")), " ")
    whole = found.where("_times > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select("_doc.*")
    cut = found.where("_part > 0").select(*[first_words.alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
    return whole.unionByName(cut)
