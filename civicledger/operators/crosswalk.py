"""Names as they are written mapped to canonical keys, and currencies to a common one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.functions.money import MONEY
from civicledger.operators.asof import as_of
from civicledger.session import scratch_dir


def normalise_name(name: Column) -> Column:
    """Case, punctuation and blanks do not distinguish names."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", " "))


def _mapping(crosswalk: DataFrame) -> DataFrame:
    """One row per normalised alias: all its canonical keys with the years they hold for."""
    own = [c for c in ("valid_from", "valid_to") if c in crosswalk.columns]
    spans = [F.coalesce(F.col(c) if c in own else F.lit(None).cast("int"), F.lit(d)).alias(c) for c, d in (("valid_from", 0), ("valid_to", 9999))]
    entry = F.struct("canonical", *spans)
    alias = normalise_name(F.col("alias")).alias("_alias")
    return crosswalk.where(F.col("canonical").isNotNull()).groupBy(alias).agg(F.array_sort(F.collect_set(entry)).alias("_entries"))


def apply_crosswalk(facts: DataFrame, crosswalk: DataFrame, name: str, year: str | None = None) -> DataFrame:
    """Adds ``canonical``; every fact stays one row.

    ``crosswalk`` has (alias, canonical) and, if ``year`` is given, (valid_from, valid_to). A name without a mapping,
    or with several canonical keys for the year (or at all, without one), keeps a null: see :func:`ambiguous_aliases`.
    """
    fits = F.col("_entries")
    if year:
        fits = F.filter(fits, lambda e: F.col(year).between(e["valid_from"], e["valid_to"]))
    keys = F.array_distinct(F.transform(fits, lambda e: e["canonical"]))
    joined = facts.withColumn("_alias", normalise_name(F.col(name))).join(_mapping(crosswalk), "_alias", "left")
    canonical = F.when(F.size(keys) == 1, F.get(keys, F.lit(0)))
    return joined.withColumn("canonical", canonical).select(*facts.columns, "canonical")


def ambiguous_aliases(crosswalk: DataFrame) -> DataFrame:
    """Aliases that several canonical keys claim for one and the same year, with those keys."""
    entries = F.col("_entries")
    overlap = F.exists(
        entries,
        lambda a: F.exists(
            entries, lambda b: (a["canonical"] != b["canonical"]) & (a["valid_from"] <= b["valid_to"]) & (b["valid_from"] <= a["valid_to"])
        ),
    )
    keys = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["canonical"])))
    return _mapping(crosswalk).where(overlap).select(F.col("_alias").alias("alias"), F.array_join(keys, ",").alias("canonical_keys"))


def crosswalk_spans(crosswalk: DataFrame) -> DataFrame:
    """The validity of aliases cut into disjoint spans: ``alias``, ``valid_from``, ``valid_to``, ``canonical``, ``n_keys``.

    A sweep over the years where an entry of the alias begins or has ended: between two of them the same entries hold.
    Neighbouring spans with the same keys become one. ``canonical`` is null where several keys hold (``n_keys``); spans
    without any are left out.
    """
    entries = F.col("_entries")
    edges = F.array_sort(F.array_distinct(F.concat(F.transform(entries, lambda e: e["valid_from"]), F.transform(entries, lambda e: e["valid_to"] + 1))))
    cut = _mapping(crosswalk).select("_alias", "_entries", edges.alias("_edges"))
    keys = lambda year: F.array_sort(F.array_distinct(F.transform(F.filter(entries, lambda e: year.between(e["valid_from"], e["valid_to"])), lambda e: e["canonical"])))
    pieces = F.transform(
        F.slice("_edges", F.lit(1), F.size("_edges") - 1),
        lambda year, i: F.struct(year.alias("valid_from"), (F.get("_edges", i + 1) - 1).alias("valid_to"), keys(year).alias("keys")),
    )

    def joined(spans: Column, piece: Column) -> Column:
        last = F.try_element_at(spans, F.lit(-1))
        goes_on = F.coalesce((last["keys"] == piece["keys"]) & (last["valid_to"] + 1 == piece["valid_from"]), F.lit(False))
        longer = F.struct(last["valid_from"].alias("valid_from"), piece["valid_to"].alias("valid_to"), piece["keys"].alias("keys"))
        return F.when(goes_on, F.array_append(F.slice(spans, F.lit(1), F.size(spans) - 1), longer)).otherwise(F.array_append(spans, piece))

    swept = cut.select("_alias", F.filter(pieces, lambda p: F.size(p["keys"]) > 0).alias("_pieces"))
    none = F.array().cast("array<struct<valid_from:int,valid_to:int,keys:array<string>>>")
    spans = swept.select("_alias", F.inline(F.aggregate("_pieces", none, joined)))
    single = F.when(F.size("keys") == 1, F.get("keys", F.lit(0)))
    return spans.select(F.col("_alias").alias("alias"), "valid_from", "valid_to", single.alias("canonical"), F.size("keys").alias("n_keys"))


def apply_spans(facts: DataFrame, spans: DataFrame, name: str, year: str) -> DataFrame:
    """Adds ``canonical`` by disjoint spans: the last one that begins by the fact's year, if it hasn't ended by then."""
    step = F.struct(F.col("valid_to").alias("until"), "canonical").alias("_span")
    steps = spans.select(F.col("alias").alias("_alias"), F.col("valid_from").alias("_since"), step)
    named = facts.withColumns({"_alias": normalise_name(F.col(name)), "_year": F.col(year).cast("int")})
    found = as_of(named, steps, "_alias", "_year", "_since", "_span")
    return found.withColumn("canonical", F.when(F.col("_span.until") >= F.col("_year"), F.col("_span.canonical"))).select(*facts.columns, "canonical")


def assign_matches(spark: SparkSession, pairs: DataFrame, left: str = "name", right: str = "canonical", cost: str = "edits") -> DataFrame:
    """One-to-one choice among candidate pairs, cheapest first; ties by the names.

    A pair that is the best of both its sides is chosen, then everything else of either side is dropped, until no
    candidate is left; that is the choice of going through all pairs in order of cost. Rounds are written; minima
    combine before they move, so a name with very many candidates is no large group.
    """
    base = scratch_dir(spark, "matches")
    rank = F.struct(F.col(cost).alias("cost"), F.col(left).alias("l"), F.col(right).alias("r"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    open_ = kept(pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(left, right).agg(F.min(cost).alias(cost)), "open-0")
    chosen, round_ = open_.limit(0), 0
    while open_.head(1):
        round_ += 1
        ranked = open_.withColumn("_rank", rank)
        first, second = (ranked.groupBy(c).agg(F.min("_rank").alias("_best")) for c in (left, right))
        best = first.select("_best").intersect(second.select("_best")).select("_best.*")
        new = kept(best.select(F.col("l").alias(left), F.col("r").alias(right), F.col("cost").alias(cost)), f"chosen-{round_}")
        chosen = chosen.union(new)
        open_ = kept(open_.join(new.select(left), left, "left_anti").join(new.select(right), right, "left_anti").select(left, right, cost), f"open-{round_}")
    return chosen


def unmatched_names(facts: DataFrame, crosswalk: DataFrame, name: str) -> DataFrame:
    """Names that the crosswalk does not know, with how often they occur."""
    counted = facts.groupBy(normalise_name(F.col(name)).alias("name")).agg(F.count("*").alias("n_rows"))
    known = crosswalk.select(normalise_name(F.col("alias")).alias("name"))
    return counted.join(known, "name", "left_anti")


def _with_deletions(names: DataFrame, column: str, distance: int) -> DataFrame:
    """Every string left after deleting up to ``distance`` letters."""

    def shorter(word: Column) -> Column:
        cuts = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))
        return F.transform(cuts, lambda i: F.concat(F.substring(word, 1, 0 + i - 1), F.substr(word, i + 1)))

    forms = F.array(F.col(column))
    for _ in range(distance):
        forms = F.array_distinct(F.concat(forms, F.flatten(F.transform(forms, shorter))))
    return names.withColumn("_form", F.explode(forms))


def suggest_matches(unmatched: DataFrame, crosswalk: DataFrame, distance: int = 2) -> DataFrame:
    """Canonical names within an edit distance of each unmatched name.

    Two strings that are ``distance`` edits apart share a form with at most that many letters deleted, so
    an equality join on those forms finds every candidate without comparing all pairs.
    """
    known = crosswalk.select(normalise_name(F.col("alias")).alias("alias"), "canonical").distinct()
    left = _with_deletions(unmatched.select("name").distinct(), "name", distance)
    right = _with_deletions(known, "alias", distance)
    # Names no longer than the distance all share the empty form; they meet by length instead.
    short = F.lit(distance)
    long_pairs = left.where("_form <> ''").join(right.where("_form <> ''"), "_form")
    few = unmatched.select("name").distinct().where(F.length("name") <= short), known.where(F.length("alias") <= short)
    one, two = (df.withColumn("_letter", F.explode(F.array_distinct(F.split(F.concat(F.lit("."), c), "")))) for df, c in zip(few, ("name", "alias"), strict=True))
    short_pairs = one.join(two, "_letter")
    pairs = long_pairs.select("name", "alias", "canonical").union(short_pairs.select("name", "alias", "canonical")).distinct()
    edits = F.levenshtein(F.col("name"), F.col("alias"))
    return pairs.withColumn("edits", edits).where(F.col("edits") <= distance)


def align_currency(facts: DataFrame, rates: DataFrame, amount: str = "amount") -> DataFrame:
    """Amounts in a common currency; every fact stays one row.

    A currency without a rate, or with several different ones, gives null and stays visible.
    """
    distinct = rates.groupBy("currency").agg(F.min("rate").alias("_low"), F.max("rate").alias("_high"))
    one = distinct.select("currency", F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("rate"))
    joined = facts.join(one, "currency", "left")
    return joined.withColumn("amount_common", (F.col(amount) * F.col("rate")).cast(MONEY))


def align_currency_as_of(facts: DataFrame, rates: DataFrame, at: str, amount: str = "amount") -> DataFrame:
    """Amounts in a common currency by the rate that held on the fact's day; adds ``rate``, ``valid_since``, ``amount_common``.

    ``rates``: currency, valid_since, rate. Before the first rate, and while rates contradict each other, all are null.
    """
    found = as_of(facts, rates, "currency", at, "valid_since", "rate")
    return found.withColumn("amount_common", (F.col(amount) * F.col("rate")).cast(MONEY))


def clean_columns(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Snake-case column names; rows that lack a required value are dropped."""
    import re

    renamed = df.toDF(*[re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_") for name in df.columns])
    return renamed.na.drop(subset=required) if required else renamed


def key_checks(facts: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """Rows, duplicated keys and missing required values, as one row.

    Keys are counted before they are judged, so a key that repeats very often is one partial count per task.
    """
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required]
    per_key = facts.groupBy(*key).agg(F.count("*").alias("_n"), *missing)
    totals = [F.coalesce(F.sum(f"missing_{c}"), F.lit(0)).alias(f"missing_{c}") for c in required]
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("n_duplicated_keys"),
        *totals,
    )


def duplicated_keys(facts: DataFrame, key: list[str]) -> DataFrame:
    return facts.groupBy(*key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def compare_periods(first: DataFrame, second: DataFrame, column: str = "year") -> DataFrame:
    """Values covered by either input, and whether each of them covers it."""
    marked = first.select(column, F.lit(True).alias("a"), F.lit(False).alias("b")).unionByName(
        second.select(column, F.lit(False).alias("a"), F.lit(True).alias("b"))
    )
    return marked.groupBy(column).agg(F.bool_or("a").alias("in_first"), F.bool_or("b").alias("in_second"))
