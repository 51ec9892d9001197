"""Request vectors whose derived columns are recomputed from what the request supplies.

``screen.request_vectors`` leaves every derived column at its training median. Here a request may supply raw
values (numbers, category texts, the opening date) and the columns that depend on them follow: temporal
features, missing counts and flags, row moments, products, ratios, z-scores. The rules form a graph from
column names to column names; a request evaluates it level by level, and a rule takes effect only for
requests that supply something it depends on.

Defined results: an absent name counts as present with its training median; a name with a NULL value is a
missing cell (counted and flagged, then imputed); a derived name that is supplied itself wins over its rule;
a rule that gives NULL falls back to the median; unknown names are ignored; a numeric name whose text is no
number sets ``parse_error``; categories never seen take the encoder's value for unknown ones; requests with
one ``account_id`` stay separate rows; detector columns (``iforest_``, ``ae_``) have no rule and keep medians.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.dates import parse_open_date, temporal_columns
from riskloom.functions.params import attach_params
from riskloom.operators import encode, features, fitted

_TABLES = ("codes", "shares", "medians", "zparams")


@dataclass(frozen=True)
class Derivation:
    """What fitting left behind: the columns of the encoded table in order, how its string columns are encoded,
    the parameters of the derived families, and the fitted tables. ``shares`` grows with the categories and is
    only joined; the others have one row a column, at most 51 a string column, or one."""

    columns: tuple[str, ...]
    encodings: Mapping[str, str]
    manual: Mapping[str, Mapping[str, int]]
    date_col: str | None
    ref_date: _dt.date
    flags: tuple[str, ...]
    keys: tuple[str, ...]
    ratios: tuple[tuple[str, str], ...]
    age_keys: tuple[str, ...]
    z_targets: tuple[str, ...]
    codes: DataFrame
    shares: DataFrame
    medians: DataFrame
    zparams: DataFrame


@dataclass(frozen=True)
class Rule:
    """Columns that are computed together from ``inputs``."""

    inputs: tuple[str, ...]
    outputs: Mapping[str, Column]


def missing_name(c: str) -> str:
    """The working column of ``c`` before imputation."""
    return f"?{c}"


def fit(raw: DataFrame, train: DataFrame, *, columns: Sequence[str], encodings: Mapping[str, str], manual: Mapping[str, Mapping[str, int]],
        date_col: str | None, ref_date: _dt.date, flags: Sequence[str], keys: Sequence[str] = (), ratios: Sequence[tuple[str, str]] = (),
        age_keys: Sequence[str] = (), z_targets: Sequence[str] = ()) -> Derivation:
    """Fit on ``raw`` (categories) and ``train``, the cleaned table with its row moments (medians, z moments).
    Imputing a median leaves the median as it was, so ``train`` may be imputed already."""
    from riskloom.session import cut_lineage

    spark = raw.sparkSession
    ordinal, frequency = ([c for c, k in encodings.items() if k == kind] for kind in ("ordinal", "frequency"))
    if ordinal or frequency:
        counts = cut_lineage(encode.category_counts(raw, [*ordinal, *frequency]))
        codes = encode.ordinal_codes(counts.where(F.col("feature").isin(ordinal)))
        shares = encode.category_shares(counts.where(F.col("feature").isin(frequency)))
    else:
        codes = spark.createDataFrame([], "feature string, category string, code double")
        shares = spark.createDataFrame([], "feature string, category string, share double")
    more = features.interaction_columns(train, keys, ratios, age_keys=age_keys)
    whole = train.select("*", *[v.alias(k) for k, v in more.items()])
    z = list(z_targets)
    if z:
        moments = cut_lineage(fitted.zscore_params(whole, z))
        whole = attach_params(whole, moments).select(*whole.columns, *[v.alias(k) for k, v in fitted.z_expressions(z).items()])
    else:
        moments = spark.createDataFrame([(0.0,)], "_none double")
    derived = [c for c in whole.columns if c not in ("account_id", "y", "fold")]
    return Derivation(tuple(columns), dict(encodings), manual, date_col, ref_date, tuple(flags), tuple(keys), tuple(tuple(r) for r in ratios),
                      tuple(age_keys), tuple(z), codes, shares, features.medians(whole, derived), moments)


def rules(d: Derivation) -> list[Rule]:
    """The derived columns of ``d``; inputs with a leading ? are values before imputation."""
    out = []
    temporal = temporal_columns(_supplied_date(d), d.ref_date) if d.date_col else {}
    if temporal:
        out.append(Rule((d.date_col,), temporal))
    counted = (*(missing_name(c) for c in d.columns), *temporal)
    out.append(Rule(counted, features.row_meta_columns(counted)))
    out += [Rule((missing_name(c),), {f"miss_flag_{c}": F.col(missing_name(c)).isNull().cast("double")}) for c in d.flags]
    if d.columns:
        out.append(Rule(d.columns, features.row_stat_columns(d.columns)))
    present = [k for k in d.keys if k in d.columns]
    out += [Rule((a, b), {f"int_{a}x{b}": F.col(a) * F.col(b)}) for i, a in enumerate(present) for b in present[i + 1:]]
    out += [Rule((a, b), {f"ratio_{a}_{b}": F.try_divide(F.col(a), F.col(b) + F.lit(features.EPS))})
            for a, b in d.ratios if a in d.columns and b in d.columns]
    age = "feat_account_age_days"
    out += [Rule((age, k), {f"int_age_{k}": F.col(age) * F.col(k)}) for k in d.age_keys if age in temporal and k in d.columns]
    z = fitted.z_expressions(d.z_targets)
    out += [Rule((c,), {n: z[n] for n in (f"z_{c}", f"zflag_{c}")}) for c in d.z_targets]
    if d.z_targets:
        flags = [f"zflag_{c}" for c in d.z_targets]
        total = F.col(flags[0])
        for f in flags[1:]:
            total = total + F.col(f)
        out.append(Rule(tuple(flags), {"z_composite_score": total}))
    return out


def levels(graph: Sequence[Rule], wanted: Sequence[str]) -> list[list[Rule]]:
    """The rules that ``wanted`` needs, in levels: a level reads only columns of earlier ones."""
    by_output = {n: i for i, r in enumerate(graph) for n in r.outputs}
    needed: set[int] = set()
    todo = [by_output[w] for w in wanted if w in by_output]
    while todo:
        i = todo.pop()
        if i not in needed:
            needed.add(i)
            todo += [by_output[c] for c in graph[i].inputs if c in by_output]
    order = TopologicalSorter({i: {by_output[c] for c in graph[i].inputs if c in by_output} for i in needed})
    order.prepare()
    out = []
    while order.is_active():
        ready = sorted(order.get_ready())
        out.append([graph[i] for i in ready])
        order.done(*ready)
    return out


def roots(graph: Sequence[Rule]) -> dict[str, frozenset[str]]:
    """For every output: the request names on which it depends, through any number of rules."""
    by_output = {n: r for r in graph for n in r.outputs}
    known: dict[str, frozenset[str]] = {}
    for level in levels(graph, list(by_output)):
        for r in level:
            names = frozenset(c.removeprefix("?") for c in r.inputs)
            for c in r.inputs:
                names |= known.get(c, frozenset())
            known.update({n: names for n in r.outputs})
    return known


def _supplied_date(d: Derivation) -> Column:
    return parse_open_date(F.col("__given")[d.date_col], d.ref_date)


def _with_shares(requests: DataFrame, d: Derivation) -> DataFrame:
    """Add ``__shares``, the map of the requests' categories to their shares, by one join on (column, value)."""
    from riskloom.session import cut_lineage

    frequency = [c for c, k in d.encodings.items() if k == "frequency"]
    if not frequency:
        return requests
    rows = cut_lineage(requests.withColumn("__row", F.monotonically_increasing_id()))  # the row numbers are read twice
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("__given")[c].alias("category")) for c in frequency])
    long = rows.select("__row", F.explode(items).alias("e")).select("__row", "e.feature", "e.category").where(F.col("category").isNotNull())
    # merged: as many shares as categories, in a small file by which Spark would broadcast them
    found = long.join(d.shares.hint("merge"), ["feature", "category"]).groupBy("__row").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "share"))).alias("__shares"))  # an entry a column
    return rows.join(found, "__row", "left").drop("__row")


def _encoded(c: str, d: Derivation) -> Column:
    kind, text = d.encodings[c], F.col("__given")[c]
    if kind == "manual":
        pairs = F.create_map(*[x for k, v in d.manual[c].items() for x in (F.lit(k), F.lit(float(v)))])
        return F.coalesce(pairs[text], F.lit(-1.0))
    if kind == "ordinal":
        return F.coalesce(F.col("__codes")[F.concat_ws("\0", F.lit(c), F.coalesce(text, F.lit("nan")))], F.lit(-1.0))
    return F.coalesce(F.col("__shares")[c], F.lit(0.0))


def recompute(requests: DataFrame, d: Derivation, names: Sequence[str], medians: DataFrame | None = None) -> DataFrame:
    """``(account_id, *names, parse_error)`` of requests ``(account_id, features MAP<STRING, STRING>)``.
    ``medians`` (feature, median) adds to the fitted ones, for names that ``d`` doesn't know."""
    graph = rules(d)
    plan, upstream = levels(graph, names), roots(graph)
    med = d.medians if medians is None else d.medians.unionByName(
        medians.select("feature", "median").join(d.medians, "feature", "left_anti"))
    work = requests.select("account_id", F.coalesce("features", F.create_map().cast("map<string,string>")).alias("__given"))
    work = _with_shares(work, d)
    work = attach_params(work, med.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median"))).alias("__med")))
    entry = F.struct(F.concat_ws("\0", "feature", "category").alias("k"), F.col("code").alias("v"))
    work = attach_params(work, d.codes.agg(F.map_from_entries(F.collect_list(entry)).alias("__codes")))
    if d.z_targets:
        work = attach_params(work, d.zparams)

    def given(c: str) -> Column:
        return F.col("__given")[c].try_cast("double")

    def median(c: str) -> Column:
        return F.col("__med")[c]

    numeric = sorted({*(c for c in d.columns if c not in d.encodings), *(n for n in names if n not in d.encodings), *upstream})
    known = F.array(*[F.lit(n) for n in numeric])
    bad = F.filter(F.map_keys("__given"), lambda k: F.array_contains(known, k) & F.col("__given")[k].isNotNull()
                   & F.col("__given")[k].try_cast("double").isNull())
    error = F.when(F.size(bad) > 0, F.concat(F.lit("could not convert value of "), F.element_at(F.array_sort(bad), 1), F.lit(" to float")))
    work = work.withColumns({"parse_error": error, "__names": F.map_keys("__given")})
    before = {missing_name(c): F.when(F.array_contains("__names", c), _encoded(c, d) if c in d.encodings else given(c)).otherwise(median(c))
              for c in d.columns}
    work = work.withColumns(before)
    work = work.withColumns({c: F.coalesce(F.col(missing_name(c)), median(c)) for c in d.columns})
    for level in plan:
        groups = sorted({upstream[n] for r in level for n in r.outputs}, key=sorted)
        touched = {g: f"__touched{i}" for i, g in enumerate(groups)}
        work = work.withColumns({flag: F.arrays_overlap("__names", F.array(*[F.lit(n) for n in sorted(g)])) for g, flag in touched.items()})
        work = work.withColumns({n: F.coalesce(given(n), F.when(F.col(touched[upstream[n]]), v.cast("double")), median(n))
                                 for r in level for n, v in r.outputs.items()})
    plain = [n for n in names if n not in upstream and n not in d.columns]
    work = work.withColumns({n: F.coalesce(given(n), median(n)) for n in plain}) if plain else work
    return work.select("account_id", *[F.col(f"`{n}`") for n in names], "parse_error")


def save(d: Derivation, folder: str) -> str:
    """Write the fitted tables below ``folder``; the rest as text, for ``load``."""
    for t in _TABLES:
        getattr(d, t).write.parquet(os.path.join(folder, t))
    return json.dumps({"columns": d.columns, "encodings": d.encodings, "manual": d.manual, "date_col": d.date_col, "ref_date": d.ref_date.isoformat(),
                       "flags": d.flags, "keys": d.keys, "ratios": d.ratios, "age_keys": d.age_keys, "z_targets": d.z_targets})


def load(spark: SparkSession, folder: str, text: str) -> Derivation:
    v = json.loads(text)
    listed = {k: tuple(v[k]) for k in ("columns", "flags", "keys", "age_keys", "z_targets")}
    return Derivation(**listed, ratios=tuple(tuple(r) for r in v["ratios"]), encodings=v["encodings"], manual=v["manual"], date_col=v["date_col"],
                      ref_date=_dt.date.fromisoformat(v["ref_date"]), **{t: spark.read.parquet(os.path.join(folder, t)) for t in _TABLES})
