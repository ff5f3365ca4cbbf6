"""Country names beyond the exact list: name forms, names within names, and rare words.

A country has several forms: codes, its short, official and common name, and aliases given as data.
A name that no override knows is looked up in four steps; the first that finds a country decides:

1. *exact*: it equals a form, letter case and accents aside (ties: codes, name, official, common, alias, then iso3).
2. *within*: it occurs inside names; a form counts 30 less twice the place where it occurs, 5 at least, and a
   country the sum over its forms (ties: smaller iso3).
3. *words*: it shares words with a form, each weighing its inverse document frequency among the forms;
   the share of the common weight in the weight of both together is at least ``LEAST`` (ties: smaller iso3).
4. *edits*: the closest short name within two edits (``lookup``).

No step compares all pairs. Step 2 joins on a name's rarest piece of three letters, which every form
that holds the name must have; step 3 joins on the rarest words of a name alone: if a form
shares none of them, the words that are left can't reach ``LEAST``. All steps work on distinct names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfabric.operators.lookup import _edit_block

#: Least weighted share of common words.
LEAST = 0.6
#: Forms by rank; the first three are codes and the short name, as in ``lookup.country_name_candidates``.
KINDS = ["iso3", "iso2", "name", "official_name", "common_name", "alias"]

# Letters with a mark, and the letters they fold to.
_MARKED = "àáâãäåāăçćčďèéêëēĕėęěğìíîïīįıłñńňòóôõöøōőřśşšţťùúûüūůűýÿžźż"
_FOLDED = "aaaaaaaacccdeeeeeeeeegiiiiiiilnnnoooooooorssstt" + "uuuuuuuyyzzz"


def folded(c: Column) -> Column:
    """Lower case without accents, trimmed."""
    return F.trim(F.translate(F.lower(c), _MARKED, _FOLDED))


def forms(countries: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(iso3, form, kind, rank) of every name form; columns that ``countries`` lacks give none.

    ``aliases`` has (iso3, alias). Kinds are those of ``KINDS``.
    """
    parts = [
        countries.select("iso3", folded(F.col(kind)).alias("form"), F.lit(kind).alias("kind"), F.lit(i).alias("rank"))
        for i, kind in enumerate(KINDS) if kind in countries.columns
    ]
    if aliases is not None:
        parts.append(aliases.select("iso3", folded(F.col("alias")).alias("form"), F.lit("alias").alias("kind"), F.lit(len(KINDS) - 1).alias("rank")))
    all_forms = parts[0]
    for p in parts[1:]:
        all_forms = all_forms.unionByName(p)
    return all_forms.where("form <> ''").distinct()


def _pieces(text: str, size: str) -> Column:
    """The distinct pieces of ``size`` letters of a column."""
    return F.expr(f"array_distinct(transform(sequence(1, greatest(length({text}) - {size} + 1, 1)), i -> substring({text}, i, {size})))")


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def within(probes: DataFrame, names: DataFrame) -> DataFrame:
    """(probe, within_iso3): the country whose names hold the probe, by points."""
    sizes = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("size")
    grams = names.select("iso3", "kind", "form", sizes).select("iso3", "kind", "form", "size", F.explode(_pieces("form", "size")).alias("gram"))
    common = grams.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("n"))
    asked = probes.select("probe", F.least(F.length("probe"), F.lit(3)).alias("size"))
    asked = asked.select("probe", "size", F.explode(_pieces("probe", "size")).alias("gram"))
    # A piece that no form has rules the probe out; else its rarest piece is its key.
    counted = asked.join(common, ["size", "gram"], "left").groupBy("probe", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("key"))
    key = counted.where("key.n > 0").select("probe", "size", F.col("key.gram").alias("gram"))
    hits = key.join(grams, ["size", "gram"]).withColumn("at", F.expr("position(probe, form)")).where("at > 0")
    points = hits.groupBy("probe", "iso3").agg(F.sum(F.greatest(F.lit(5), 30 - 2 * (F.col("at") - 1))).alias("points"))
    return points.groupBy("probe").agg(F.min(F.struct(-F.col("points"), "iso3")).alias("b")).select("probe", F.col("b.iso3").alias("within_iso3"))


def _weights(names: DataFrame) -> tuple[DataFrame, Column]:
    """(word, idf) over the forms, and the idf of a word that none has."""
    words = names.select(F.monotonically_increasing_id().alias("f"), F.explode(_words(F.col("form"))).alias("word"))
    total = names.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = words.groupBy("word").agg(F.log((total + 1) / F.count(F.lit(1))).alias("idf"))
    return idf, F.log(total + F.lit(1.0))


def by_words(probes: DataFrame, names: DataFrame, least: float = LEAST) -> DataFrame:
    """(probe, words_iso3): the form whose words share most weight with the probe's, at ``least`` or more."""
    idf, unknown = _weights(names)

    def weighed(df: DataFrame, *keys: str) -> DataFrame:
        each = df.select(*keys, F.explode(_words(F.col(keys[-1]))).alias("word")).join(idf, "word", "left")
        each = each.withColumn("idf", F.coalesce("idf", unknown))
        return each.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("idf", "word")), asc=False).alias("ws"), F.sum("idf").alias("weight"))

    asked, known = weighed(probes.select("probe"), "probe"), weighed(names.select("iso3", "form").distinct(), "iso3", "form")
    # The rarest words up to the first after which less than ``least`` of the weight remains.
    before = "aggregate(slice(ws, 1, i), 0D, (s, x) -> s + x.idf)"
    prefix = F.expr(f"transform(filter(sequence(0, size(ws) - 1), i -> weight - {before} >= {least} * weight - 1e-9), i -> ws[i].word)")
    asked = asked.withColumn("key", F.explode(prefix)).select("probe", F.col("ws").alias("p_ws"), F.col("weight").alias("p_weight"), "key")
    known = known.withColumn("key", F.explode(F.expr("transform(ws, x -> x.word)")))
    pairs = asked.join(known, "key").drop("key").distinct()
    common = F.expr("aggregate(filter(p_ws, x -> exists(ws, y -> y.word = x.word)), 0D, (s, x) -> s + x.idf)")
    share = (F.col("common") / (F.col("p_weight") + F.col("weight") - F.col("common"))).alias("share")
    scored = pairs.withColumn("common", common).select("probe", "iso3", F.round(share, 9).alias("share")).where(F.col("share") >= least)
    return scored.groupBy("probe").agg(F.min(F.struct(-F.col("share"), "iso3")).alias("b")).select("probe", F.col("b.iso3").alias("words_iso3"))


def resolve(values: DataFrame, col: str, countries: DataFrame, overrides: DataFrame, aliases: DataFrame | None = None, max_distance: int = 2) -> DataFrame:
    """Distinct ``col`` values → (raw, iso3, how): the country and the step that found it (NULL where none did)."""
    names = forms(countries, aliases)
    d = values.select(F.col(col).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    d = d.withColumn("probe", folded(F.col("raw"))).where("probe <> ''")
    ov = overrides.select(folded(F.col("name")).alias("probe"), F.col("iso3").alias("override_iso3")).dropDuplicates(["probe"])
    best = names.groupBy(F.col("form").alias("probe")).agg(F.min(F.struct("rank", "iso3")).alias("b"))
    found = d.join(ov, "probe", "left").join(best.select("probe", F.col("b.iso3").alias("exact_iso3")), "probe", "left")
    spelt = names.where(~F.col("kind").isin("iso3", "iso2"))
    todo = found.where("override_iso3 IS NULL AND exact_iso3 IS NULL").select("probe").distinct()
    short = names.where("kind = 'name'").select(F.col("iso3").alias("f_iso3"), F.col("form").alias("cname"))
    edits = _edit_block(todo, short, max_distance).withColumn("dist", F.levenshtein("probe", "cname")).where(F.col("dist") <= max_distance)
    edits = edits.groupBy("probe").agg(F.min(F.struct("dist", "f_iso3")).alias("b")).select("probe", F.col("b.f_iso3").alias("edits_iso3"))
    for step in (within(todo, spelt), by_words(todo, spelt), edits):
        found = found.join(step, "probe", "left")
    steps = ["override", "exact", "within", "words", "edits"]
    how = F.coalesce(*[F.when(F.col(f"{s}_iso3").isNotNull(), s) for s in steps])
    return found.select("raw", F.coalesce(*[f"{s}_iso3" for s in steps]).alias("iso3"), how.alias("how"))
