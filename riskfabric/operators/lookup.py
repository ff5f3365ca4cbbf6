"""Code lookups (J10–J13), resolved on DISTINCT input values and joined back.

Name lookups join the input once against small, size-checked lookup tables
(broadcast hash joins), so a raw file is parsed once. Steps whose work depends on
the value itself (fuzzy search, news-country cascade, prefix search) resolve the
DISTINCT values first — bounded by the number of distinct names/codes, not by
the rows — and join the answer back with an equi-join whose small side Spark
broadcasts when its measured size allows (auto-broadcast threshold / AQE).

The ordered prefix lookup (J13) against a fixed list is one expression over a
constant array (``prefix_value``): no join, no shuffle on the codes, of which a few
may hold most rows. Against a mapping table (``resolve_prefix``) each distinct code
is expanded into its own prefixes (bounded by the code length) and equi-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _norm_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def exact_lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str,
                 normalise=None) -> DataFrame:
    """Left lookup ``out = table[value] where table[key] = norm(df[col])``."""
    norm = normalise or (lambda c: c)
    # one value per key; on duplicate keys the smallest value wins (deterministic)
    t = table.groupBy(F.col(key).alias("_lk_key")).agg(F.min(value).alias(out))
    j = df.withColumn("_lk_probe", norm(F.col(col))).join(t, F.col("_lk_probe") == t["_lk_key"], "left")
    return j.drop("_lk_probe", "_lk_key")


def country_name_candidates(countries: DataFrame) -> DataFrame:
    """(probe, iso3) pairs accepted by the exact country lookup: alpha-3, alpha-2 and name, lower-cased.

    When several countries share a probe the alphabetically first iso3 wins.
    """
    parts = [
        countries.select(_norm_lower(F.col("iso3")).alias("probe"), F.col("iso3").alias("iso3"), F.lit(0).alias("rank")),
        countries.select(_norm_lower(F.col("iso2")).alias("probe"), F.col("iso3"), F.lit(1).alias("rank")),
        countries.select(_norm_lower(F.col("name")).alias("probe"), F.col("iso3"), F.lit(2).alias("rank")),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("probe").isNotNull() & (F.col("probe") != ""))
    best = u.groupBy("probe").agg(F.min(F.struct("rank", "iso3")).alias("b"))
    return best.select("probe", F.col("b.iso3").alias("iso3"))


def _edit_block(probes: DataFrame, names: DataFrame, d: int) -> DataFrame:
    """Pairs of ``probes`` (probe) and ``names`` (cname) that may be within ``d`` edits, by an equi-join.

    A name is cut into d + 1 segments. At most d edits leave one of them whole, moved by at
    most d places, so the pair shares (name's length, segment number, segment's text).
    """
    part = f"floor((_seg * _len) / {d + 1})", f"floor(((_seg + 1) * _len) / {d + 1})"
    segments = F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_seg")
    span = [F.expr(part[0]).cast("int").alias("_from"), F.expr(f"{part[1]} - {part[0]}").cast("int").alias("_n")]
    cut = names.select("*", F.length("cname").alias("_len"), segments).select("*", *span)
    cut = cut.withColumn("_text", F.expr("substring(cname, _from + 1, _n)")).drop("_from", "_n")
    moved = F.explode(F.sequence(F.lit(-d), F.lit(d)))
    asked = probes.select("*", moved.alias("_longer")).withColumn("_len", F.length("probe") + F.col("_longer")).where("_len >= 0")
    asked = asked.select("*", segments).select("*", *span).select("*", moved.alias("_shift"))
    asked = asked.where("_from + _shift >= 0 AND _from + _shift + _n <= length(probe)")
    asked = asked.withColumn("_text", F.expr("substring(probe, _from + _shift + 1, _n)")).drop("_longer", "_from", "_n", "_shift")
    return asked.distinct().join(cut, ["_len", "_seg", "_text"]).drop("_len", "_seg", "_text").distinct()


def resolve_names(names: DataFrame, col: str, countries: DataFrame, overrides: DataFrame,
                  fuzzy: bool = False, max_distance: int = 2) -> DataFrame:
    """Distinct ``col`` values → ``iso3`` by override → exact ISO lookup → optional fuzzy → NULL.

    ``overrides`` has columns (name, iso3) with lower-case names. The fuzzy step takes
    the closest country name within ``max_distance`` edits (ties to the smaller iso3); every
    such name is a candidate (``_edit_block``).
    """
    d = names.select(F.col(col).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    d = d.withColumn("probe", _norm_lower(F.col("raw"))).where(F.col("probe") != "")
    ov = overrides.select(F.col("name").alias("probe"), F.col("iso3").alias("ov_iso3"))
    ex = country_name_candidates(countries).withColumnRenamed("iso3", "ex_iso3")
    r = d.join(ov, "probe", "left").join(ex, "probe", "left")
    resolved = r.select("raw", "probe", F.coalesce("ov_iso3", "ex_iso3").alias("iso3"))
    if not fuzzy:
        return resolved.select("raw", "iso3")
    todo = resolved.where(F.col("iso3").isNull()).select("raw", "probe")
    cand = countries.where(F.col("name").isNotNull()).select(
        F.col("iso3").alias("f_iso3"), _norm_lower(F.col("name")).alias("cname"))
    m = _edit_block(todo, cand, max_distance).withColumn("dist", F.levenshtein("probe", "cname"))
    m = m.where(F.col("dist") <= max_distance)
    best = m.groupBy("raw").agg(F.min(F.struct("dist", "f_iso3")).alias("b")).select(
        "raw", F.col("b.f_iso3").alias("fz_iso3"))
    out = resolved.join(best, "raw", "left")
    return out.select("raw", F.coalesce("iso3", "fz_iso3").alias("iso3"))


def attach(df: DataFrame, col: str, resolved: DataFrame, out: str) -> DataFrame:
    """Join resolved (raw, iso3) back onto ``df`` by the raw value."""
    r = resolved.select(F.col("raw").alias("_rs_raw"), F.col("iso3").alias(out))
    return df.join(r, df[col] == r["_rs_raw"], "left").drop("_rs_raw")


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a lookup table that is small by the optimizer's estimate; else Spark decides."""
    from riskfabric.operators.asof import is_small

    return F.broadcast(df) if is_small(df) else df


def name_to_iso3(df: DataFrame, col: str, countries: DataFrame, overrides: DataFrame, out: str = "country_iso3",
                 fuzzy: bool = False) -> DataFrame:
    """``out`` = iso3 of the name in ``col``: override → exact alpha-3/alpha-2/name → optional fuzzy → NULL.

    Single pass over ``df``: the override list and the exact-probe table (at most
    three rows per country) are size-checked and broadcast, so the input is read
    once and never shuffled for the lookup. Only the fuzzy step, when enabled,
    works on the DISTINCT names that are still unresolved.
    """
    probe = F.lower(F.trim(F.col(col)))
    ov = _bounded(overrides.select(F.col("name").alias("_nl_probe"), F.col("iso3").alias("_nl_ov")))
    ex = _bounded(country_name_candidates(countries).select(F.col("probe").alias("_nl_probe"),
                                                            F.col("iso3").alias("_nl_ex")))
    j = df.withColumn("_nl_probe", probe).join(ov, "_nl_probe", "left").join(ex, "_nl_probe", "left")
    j = j.withColumn(out, F.coalesce("_nl_ov", "_nl_ex")).drop("_nl_ov", "_nl_ex", "_nl_probe")
    if not fuzzy:
        return j
    todo = j.where(F.col(out).isNull() & F.col(col).isNotNull()).select(col)
    fz = resolve_names(todo, col, countries, overrides, fuzzy=True)
    fz = fz.select(F.col("raw").alias("_nl_raw"), F.col("iso3").alias("_nl_fz"))
    j = j.join(fz, j[col] == fz["_nl_raw"], "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.col("_nl_fz"))).drop("_nl_raw", "_nl_fz")


def resolve_news_country(values: DataFrame, col: str, countries: DataFrame, fips: DataFrame,
                         overrides: DataFrame, fuzzy: bool = False) -> DataFrame:
    """Distinct source-country values → iso3: FIPS extras → ISO alpha-2 → country name.

    FIPS wins where codes clash with alpha-2 (e.g. ``CH`` → CHN, ``IS`` → ISR).
    """
    d = values.select(F.col(col).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    d = d.withColumn("code", F.upper(F.trim(F.col("raw"))))
    fp = fips.select(F.col("key").alias("code"), F.col("iso3").alias("fips_iso3"))
    a2 = countries.where(F.col("iso2").isNotNull()).groupBy(F.upper(F.col("iso2")).alias("code")).agg(
        F.min("iso3").alias("a2_iso3"))
    r = d.join(fp, "code", "left").join(a2, "code", "left")
    by_code = r.select("raw", F.coalesce("fips_iso3", "a2_iso3").alias("code_iso3"))
    names = resolve_names(by_code.where(F.col("code_iso3").isNull()), "raw", countries, overrides, fuzzy)
    out = by_code.join(names.withColumnRenamed("iso3", "name_iso3"), "raw", "left")
    return out.select("raw", F.coalesce("code_iso3", "name_iso3").alias("iso3"))


def news_country_to_iso3(df: DataFrame, col: str, countries: DataFrame, fips: DataFrame, overrides: DataFrame,
                         out: str = "country_focus_iso3", fuzzy: bool = False) -> DataFrame:
    """``out`` = iso3 of a source-country value: FIPS extras → ISO alpha-2 → country name.

    Single pass: the FIPS list, the alpha-2 table and the name tables are all
    bounded and size-checked before being broadcast. FIPS wins where codes clash
    with alpha-2 (e.g. ``CH`` → CHN, ``IS`` → ISR).
    """
    code = F.upper(F.trim(F.col(col)))
    fp = _bounded(fips.select(F.col("key").alias("_nc_code"), F.col("iso3").alias("_nc_fips")))
    a2 = _bounded(countries.where(F.col("iso2").isNotNull()).groupBy(F.upper(F.col("iso2")).alias("_nc_code"))
                  .agg(F.min("iso3").alias("_nc_a2")))
    j = df.withColumn("_nc_code", code).join(fp, "_nc_code", "left").join(a2, "_nc_code", "left")
    j = name_to_iso3(j, col, countries, overrides, "_nc_name", fuzzy)
    return j.withColumn(out, F.coalesce("_nc_fips", "_nc_a2", "_nc_name")).drop("_nc_code", "_nc_fips", "_nc_a2",
                                                                               "_nc_name")


def prefix_value(code: Column, pairs: list[tuple[str, str | None]]) -> Column:
    """Value of the exact key, else of the first key (list order) that is a prefix of ``code``.

    Same rules as ``resolve_prefix``; ``pairs`` is a fixed list of (key, value).
    """
    c = F.upper(F.trim(code))
    entries = F.array(*[F.struct(F.lit(k.upper()).alias("key"), F.lit(v).cast("string").alias("value")) for k, v in pairs if k])
    exact = F.get(F.filter(entries, lambda e: e["key"] == c), F.lit(0))
    prefix = F.get(F.filter(entries, lambda e: F.startswith(c, e["key"])), F.lit(0))
    return F.when(c != "", F.coalesce(exact, prefix)["value"])


def resolve_prefix(values: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """Distinct codes → value by exact key, else the first key (map order) that is a prefix.

    ``mapping`` has (key, iso3, ord). A matched key whose value is NULL ends the
    search with NULL. Blank codes resolve to NULL.
    """
    d = values.select(F.col(col).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    d = d.withColumn("code", F.upper(F.trim(F.col("raw")))).where(F.col("code") != "")
    pref = d.select("raw", "code", F.explode(F.sequence(F.lit(1), F.length("code"))).alias("n"))
    pref = pref.select("raw", "code", F.substring(F.col("code"), F.lit(1), F.col("n")).alias("key"))
    m = mapping.select(F.upper(F.col("key")).alias("key"), "iso3", "ord")
    j = pref.join(m, "key", "inner")
    ranked = j.select("raw", F.struct((F.col("key") != F.col("code")).alias("not_exact"), "ord", "iso3").alias("r"))
    best = ranked.groupBy("raw").agg(F.min("r").alias("b")).select("raw", F.col("b.iso3").alias("iso3"))
    return d.select("raw").join(best, "raw", "left")
