"""Taxonomy-guided subgroup rule mining.

A *rule* is a conjunction of one concept per ontology for a prefix of the
ontologies ``0..j`` (columns ``c0 .. c{T-1}``, null = no term).  A fact row
matches concept ``c`` of ontology ``k`` when any column mapped to ``k`` holds
``c`` or a descendant of ``c``; the top concept matches every row unless
``top_matches_all=False``.

Physical plan (one scan of the facts, no per-rule job):

1. ``frequent_concepts`` (level one): one pass counts the positives of every
   value per ontology with map-side partial aggregation; concepts that cannot be
   in a kept rule are cut from the ancestor table.
2. ``concept_profile``: a second pass looks the remaining concepts up per mapped
   column (broadcast behind a size check, else salted) and groups the facts by
   their concept arrays -> ``<arrays, n, n_pos>``.  Values without a frequent
   concept of their own merge here, and an ontology used with its top concept
   only is not read at all, so the profile holds what rules can tell apart.
   A combination holding a third of all rows costs one row per map task.
3. ``explode_rules``: nested ``explode`` with a null suffix enumerates every
   prefix rule a combination matches (fan-out bounded by depth x columns).
4. ``groupBy(c0..)`` + ``sum`` + ``filter(pos > min_pos)``; ``N`` and ``C``
   come from scalar subqueries Catalyst merges into one.

Support is anti-monotone, so keeping every prefix rule with ``pos > min_pos``
equals the general-to-specific search with pruning; the last ontology is only
ever used with its top concept unless ``expand_last=True``.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.operators.graph import dictionary_encode
from ruleweave.operators.hierarchy import ancestor_sets
from ruleweave.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small, cut_lineage, fits, materialize, materialize_sized, small_parts
from ruleweave.operators.skew import hot_keys, lookup_join

RULE_PREFIX = "c"


@dataclass(frozen=True)
class MiningSpec:
    """How facts and taxonomies relate; defaults follow the first miner."""

    mapping: Mapping[int, Sequence[str]]
    target: str = "target"
    key: str = "id"
    top: str = "Thing"
    min_pos: int = 4
    max_terms: int = 3
    expand_last: bool = False
    top_matches_all: bool = True
    mapped_columns: list[str] = field(init=False)

    def __post_init__(self):
        cols: list[str] = []
        for k in sorted(self.mapping):
            for c in self.mapping[k]:
                if c not in cols:
                    cols.append(c)
        object.__setattr__(self, "mapped_columns", cols)

    @property
    def n_ontologies(self) -> int:
        return len(self.mapping)

    @property
    def n_terms(self) -> int:
        return min(self.max_terms, self.n_ontologies)

    @property
    def used(self) -> list[int]:
        """Ontologies that rules name, in order."""
        return sorted(self.mapping)[: self.n_terms]

    def rule_columns(self) -> list[str]:
        return [f"{RULE_PREFIX}{j}" for j in range(self.n_terms)]


def _target_flag(spec: MiningSpec) -> Column:
    return F.coalesce(F.col(spec.target).cast("boolean"), F.lit(False))


def value_profile(facts: DataFrame, spec: MiningSpec, population: str = "all") -> DataFrame:
    """``<mapped columns, n, n_pos>``: facts collapsed to distinct value combinations.

    ``population="positives"`` keeps only target rows.
    """
    df = facts
    if population == "positives":
        df = df.filter(_target_flag(spec))
    return df.groupBy(*spec.mapped_columns).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_target_flag(spec)).alias("n_pos")
    )


def _array_col(k: int) -> str:
    return f"_a{k}"


def _no_concepts() -> Column:
    return F.array().cast("array<string>")


def distinct_rows(facts: DataFrame, spec: MiningSpec) -> DataFrame:
    """Facts with equal rows (key, mapped columns and target) counted once: covers of distinct rows."""
    return facts.select(spec.key, *spec.mapped_columns, spec.target).distinct()


def with_ancestor_arrays(df: DataFrame, ancestors: DataFrame, spec: MiningSpec,
                         only: Collection[int] | None = None) -> DataFrame:
    """Add ``_a{k}`` = concepts of ontology k matched by the row (sorted arrays).

    ``only`` names the ontologies wanted (default all); each ontology's table is
    broadcast or split by its own size, one without rows is not joined.
    """
    ks = sorted(spec.mapping if only is None else set(only))
    small = small_parts(ancestors, "k")
    split = [c for k in ks if not small.get(k, True) for c in spec.mapping[k]]
    hot = hot_keys(df, list(dict.fromkeys(split))) if split else None
    out = df
    parts: dict[int, list[Column]] = {k: [] for k in ks}
    for k in ks:
        if k not in small:
            continue
        side = ancestors.filter(F.col("k") == k)
        for col in spec.mapping[k]:
            alias = f"_anc_{k}_{col}"
            look = side.select(F.col("value").alias(f"_v_{alias}"), F.col("ancs").alias(alias))
            mine = None if small[k] else hot.filter(F.col("column") == col).drop("column")
            out = lookup_join(out, look, col, f"_v_{alias}", how="left", lookup_small=small[k], hot=mine)
            parts[k].append(F.coalesce(F.col(alias), _no_concepts()))
    drops = []
    for k, cols in parts.items():
        arr = cols[0] if cols else _no_concepts()
        for c in cols[1:]:
            arr = F.array_union(arr, c)
        if spec.top_matches_all:
            arr = F.array_union(arr, F.array(F.lit(spec.top)))
        out = out.withColumn(_array_col(k), F.array_sort(F.array_distinct(arr)))
        drops += [f"_anc_{k}_{c}" for c in spec.mapping[k] if cols]
    return out.drop(*drops)


def explode_rules(df: DataFrame, spec: MiningSpec, expand_last: bool | None = None) -> DataFrame:
    """One output row per prefix rule the input row matches (columns ``c0..``)."""
    expand_last = spec.expand_last if expand_last is None else expand_last
    ks = sorted(spec.mapping)
    last = ks[-1]
    null_str = F.lit(None).cast("string")
    out = df
    for j, k in enumerate(ks[: spec.n_terms]):
        arr = F.col(_array_col(k))
        if k == last and not expand_last:
            arr = F.filter(arr, lambda x: x == F.lit(spec.top))
        name = f"{RULE_PREFIX}{j}"
        if j == 0:
            out = out.withColumn(name, F.explode(arr))
        else:
            prev = F.col(f"{RULE_PREFIX}{j - 1}")
            choices = F.when(prev.isNull(), F.array(null_str)).otherwise(F.concat(F.array(null_str), arr))
            out = out.withColumn(name, F.explode(choices))
    return out


def _totals(profile: DataFrame) -> tuple[Column, Column]:
    n_total = profile.select(F.sum("n").cast("long")).scalar()
    n_target = profile.select(F.sum("n_pos").cast("long")).scalar()
    return n_total, n_target


def score_rules(rules: DataFrame, n_total: Column, n_target: Column) -> DataFrame:
    """WRAcc, coverage and support; ``score = N*pos - cov*C`` is exact (= WRAcc*N^2)."""
    r = rules.withColumn("n_total", n_total).withColumn("n_target", n_target)
    n, c = F.col("n_total"), F.col("n_target")
    score = n * F.col("pos") - F.col("cov") * c
    return (
        r.withColumn("score", score)
        .withColumn("wracc", score.cast("double") / (n * n).cast("double"))
        .withColumn("cov_ratio", F.col("cov").cast("double") / n.cast("double"))
        .withColumn("sup", F.col("pos").cast("double") / c.cast("double"))
    )


def profile_of(facts: DataFrame, spec: MiningSpec) -> DataFrame:
    """The value profile materialised in the checkpoint folder (one pass over the facts)."""
    return cut_lineage(value_profile(facts, spec))


def restrict_ancestors(ancestors: DataFrame, keep: DataFrame, small: bool | None = None) -> DataFrame:
    """Ancestor table with every array cut down to the concepts in ``keep<k, concept>``.

    Arrays hold the ancestors of one concept (bounded by the taxonomy depth),
    so regrouping them per value is a bounded ``collect_list``.
    """
    ex = ancestors.select("k", "value", F.explode("ancs").alias("concept"))
    keep = keep.select("k", "concept").distinct()
    keep = broadcast_if_small(keep) if small is None else F.broadcast(keep) if small else keep
    kept = ex.join(keep, ["k", "concept"], "left_semi")
    return cut_lineage(kept.groupBy("k", "value").agg(F.array_sort(F.collect_list("concept")).alias("ancs")))


def _counted(facts: DataFrame, spec: MiningSpec) -> DataFrame:
    """Mapped columns with ``n`` = 1 and ``n_pos`` per fact row."""
    return facts.select(*spec.mapped_columns, F.lit(1).cast("long").alias("n"), _target_flag(spec).cast("long").alias("n_pos"))


def _top_only(spec: MiningSpec) -> int | None:
    """The ontology that rules use with its top concept only, if any."""
    last = sorted(spec.mapping)[-1]
    return last if last in spec.used and not spec.expand_last else None


def frequent_concepts(counted: DataFrame, ancestors: DataFrame, spec: MiningSpec) -> DataFrame:
    """``<k, concept>`` that kept rules may hold, of the ontologies rules use.

    Support is anti-monotone: a rule with more than ``min_pos`` positives holds
    only concepts with more than ``min_pos``.  ``counted`` has the mapped columns and
    ``n_pos``.  The values a row has in one ontology are counted as a set, so a concept
    above several of them counts once.  The last ontology gives only its top
    unless it is expanded; a top that matches every row is not listed.
    """
    ks = [k for k in spec.used if k != _top_only(spec)]
    keep = None
    if ks:
        held = F.array(*[F.struct(F.lit(k).alias("k"), F.array_sort(F.array_distinct(F.array_compact(
            F.array(*[F.col(c).cast("string") for c in spec.mapping[k]])))).alias("vals")) for k in ks])
        sets = (
            counted.filter(F.col("n_pos") > 0).select("n_pos", F.explode(held).alias("_it"))
            .groupBy(F.col("_it.k").alias("k"), F.col("_it.vals").alias("vals")).agg(F.sum("n_pos").alias("n_pos"))
        )
        above = (
            sets.select("*", F.explode("vals").alias("value")).join(ancestors, ["k", "value"])
            .select("k", "vals", "n_pos", F.explode("ancs").alias("concept"))
        )
        if any(len(spec.mapping[k]) > 1 for k in ks):
            above = above.distinct()
        if spec.top_matches_all:
            above = above.filter(F.col("concept") != spec.top)
        keep = (above.groupBy("k", "concept").agg(F.sum("n_pos").alias("_pos"))
                .filter(F.col("_pos") > spec.min_pos).select("k", "concept"))
    if _top_only(spec) is not None and not spec.top_matches_all:
        top = ancestors.sparkSession.range(1).select(F.lit(_top_only(spec)).alias("k"), F.lit(spec.top).alias("concept"))
        keep = top if keep is None else keep.unionByName(top)
    if keep is None:
        keep = ancestors.select("k", F.col("value").alias("concept")).limit(0)
    return cut_lineage(keep)


def concept_profile(counted: DataFrame, ancestors: DataFrame, spec: MiningSpec) -> DataFrame:
    """``<_a{k}.., n, n_pos>``: rows that match the same concepts of ``ancestors`` merged, written once."""
    arrays = with_ancestor_arrays(counted, ancestors, spec, spec.used)
    return cut_lineage(arrays.groupBy(*[_array_col(k) for k in spec.used])
                       .agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")))


def mine_rules(facts: DataFrame, edges: DataFrame, spec: MiningSpec,
               ancestors: DataFrame | None = None, profile: DataFrame | None = None,
               prune: bool = True) -> DataFrame:
    """All rules with ``pos > min_pos``:
    ``<c0.., cov, pos, n_total, n_target, score, wracc, cov_ratio, sup>``.

    ``profile`` (from :func:`profile_of`) may be given instead of reading the facts.
    With ``prune`` (level-wise step) the single concepts are counted first and the
    ancestor table is cut to the frequent ones, so rare leaves merge in the
    concept profile and the explode runs on what rules can tell apart.
    """
    anc = ancestors if ancestors is not None else ancestor_sets(edges, spec.top)
    counted = profile if profile is not None else _counted(facts, spec)
    if prune:
        anc = restrict_ancestors(anc, frequent_concepts(counted, anc, spec))
    combos = concept_profile(counted, anc, spec)
    rcols = spec.rule_columns()
    rules = (
        explode_rules(combos, spec).groupBy(*rcols)
        .agg(F.sum("n").cast("long").alias("cov"), F.sum("n_pos").cast("long").alias("pos"))
        .filter(F.col("pos") > spec.min_pos)
    )
    n_total, n_target = _totals(combos)
    return score_rules(rules, n_total, n_target)


def value_sets(counted: DataFrame, spec: MiningSpec, ks: Sequence[int]) -> DataFrame:
    """``<k, vals, n, n_pos>``: rows by the set of values they hold in ontology k, one pass with partial aggregation."""
    held = F.array(*[F.struct(F.lit(k).alias("k"), F.array_sort(F.array_distinct(F.array_compact(
        F.array(*[F.col(c).cast("string") for c in spec.mapping[k]])))).alias("vals")) for k in ks])
    return (counted.select("n", "n_pos", F.explode(held).alias("_it"))
            .groupBy(F.col("_it.k").alias("k"), F.col("_it.vals").alias("vals"))
            .agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")))


def mine_top_rules(facts: DataFrame, edges: DataFrame, spec: MiningSpec, k: int = 10, ancestors: DataFrame | None = None,
                   trace: list[int] | None = None) -> DataFrame:
    """The ``k`` best rules, as :func:`select_rules` over :func:`mine_rules` gives them, by branch and bound.

    A rule's score is ``N*pos - cov*C``.  Whatever is added to a rule, its positives can only shrink and its cover holds
    them, so no extension scores more than ``pos*(N - C)``.  Level by level the rules of one more term are counted; the k-th best
    score so far then cuts every rule whose bound is below it, and only survivors are extended.  The first level counts
    single concepts; concepts below the bound leave the ancestor table before the facts are profiled, so rare
    leaves merge.  Rules of equal score stay, so ties are ranked as in the full search.  ``trace`` takes the number of candidates of each level.
    """
    anc = ancestors if ancestors is not None else ancestor_sets(edges, spec.top)
    counted = _counted(facts, spec)
    ks, top_only = spec.used, _top_only(spec)
    rcols = spec.rule_columns()
    sets = cut_lineage(value_sets(counted, spec, [x for x in ks if x != top_only] or ks[:1]))
    n_total, n_target = sets.filter(F.col("k") == ks[0]).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_pos"), F.lit(0))).first()
    above = (sets.select("k", "vals", "n", "n_pos", F.explode("vals").alias("value")).join(anc, ["k", "value"])
             .select("k", "vals", "n", "n_pos", F.explode("ancs").alias("concept")).distinct())
    singles = above.groupBy("k", "concept").agg(F.sum("n").alias("cov"), F.sum("n_pos").alias("pos"))
    if spec.top_matches_all:
        whole = facts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in ks])).alias("k"), F.lit(spec.top).alias("concept"),
                                                   F.lit(n_total).alias("cov"), F.lit(n_target).alias("pos"))
        singles = singles.filter(F.col("concept") != spec.top).unionByName(whole)
    singles, n_singles = materialize(singles.filter(F.col("pos") > spec.min_pos))
    bound = F.col("pos") * F.lit(n_total - n_target)
    score = F.lit(n_total) * F.col("pos") - F.col("cov") * F.lit(n_target)
    null = F.lit(None).cast("string")

    spark = facts.sparkSession

    def best_of(found: DataFrame) -> tuple[DataFrame, int | None]:
        """The k best rules so far (k rows, through the driver) and the k-th best score."""
        rows = found.withColumn("score", score).orderBy(*rule_order(spec)).limit(k).collect()
        low = min((r["score"] for r in rows), default=None)
        return spark.createDataFrame([tuple(r)[:-1] for r in rows], found.schema), low if len(rows) == k else None

    first = singles.filter(F.col("k") == ks[0])
    if ks[0] == top_only:
        first = first.filter(F.col("concept") == spec.top)
    rules = first.select(F.col("concept").alias(rcols[0]), *[null.alias(c) for c in rcols[1:]], "cov", "pos")
    best, least = best_of(rules)
    if trace is not None:
        trace.append(n_singles)
    alive = lambda df: df if least is None else df.filter(bound >= F.lit(least))
    keep = alive(singles).filter(F.col("k") != -1 if top_only is None else F.col("k") != top_only).select("k", "concept")
    if top_only is not None and not spec.top_matches_all:
        keep = keep.unionByName(facts.sparkSession.range(1).select(F.lit(top_only).alias("k"), F.lit(spec.top).alias("concept")))
    combos = concept_profile(counted, restrict_ancestors(anc, keep, n_singles <= DEFAULT_BROADCAST_ROWS), spec) if spec.n_terms > 1 else None
    prefixes, n_level = rules, n_singles
    for j in range(1, spec.n_terms):
        prefixes = alive(prefixes).select(*rcols[:j])
        out = combos
        for x, c in zip(ks[:j + 1], rcols):
            arr = F.col(_array_col(x))
            out = out.withColumn(c, F.explode(F.filter(arr, lambda v: v == F.lit(spec.top)) if x == top_only else arr))
            if c == rcols[j - 1]:
                out = out.join(F.broadcast(prefixes) if n_level <= DEFAULT_BROADCAST_ROWS else prefixes, rcols[:j], "left_semi")
        level, n_level = materialize(
            out.groupBy(*rcols[:j + 1]).agg(F.sum("n").cast("long").alias("cov"), F.sum("n_pos").cast("long").alias("pos"))
            .filter(F.col("pos") > spec.min_pos).select(*rcols[:j + 1], *[null.alias(c) for c in rcols[j + 1:]], "cov", "pos"))
        if trace is not None:
            trace.append(n_level)
        best, least = best_of(best.unionByName(level))
        prefixes = level
    scored = score_rules(best.select(*rcols, F.col("cov").cast("long").alias("cov"), F.col("pos").cast("long").alias("pos")),
                         F.lit(n_total).cast("long"), F.lit(n_target).cast("long"))
    return select_rules(scored, spec, k)


def rule_order(spec: MiningSpec) -> list[Column]:
    """Total order for ranking: exact score, then positives, then the terms."""
    order = [F.col("score").desc(), F.col("pos").desc()]
    order += [F.col(c).asc_nulls_first() for c in spec.rule_columns()]
    return order


def select_rules(rules: DataFrame, spec: MiningSpec, k: int | None = 10) -> DataFrame:
    """Top-k rules (``TakeOrderedAndProject``) with a 1-based ``rank``.

    ``k=None`` returns all rules sorted (a global range-partitioned sort).
    """
    order = rule_order(spec)
    if k is None:
        return rules.orderBy(*order)
    top = rules.orderBy(*order).limit(k)
    # rank over at most k rows: the limit already produced one small partition
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def rule_summary(rules: DataFrame) -> DataFrame:
    """Rule-set size and averages of COV, SUP and WRAcc (from exact integer sums)."""
    agg = rules.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.sum("cov").alias("_sc"), F.sum("pos").alias("_sp"), F.sum("score").alias("_ss"),
        F.max("n_total").alias("_n"), F.max("n_target").alias("_c"),
    )
    r, n, c = F.col("n_rules").cast("double"), F.col("_n").cast("double"), F.col("_c").cast("double")
    return agg.select(
        "n_rules",
        F.col("_sc").cast("long").alias("sum_cov"), F.col("_sp").cast("long").alias("sum_pos"),
        (F.col("_sc").cast("double") / (n * r)).alias("avg_cov"),
        (F.col("_sp").cast("double") / (c * r)).alias("avg_sup"),
        (F.col("_ss").cast("double") / (n * n * r)).alias("avg_wracc"),
    )


def matches(terms: Mapping[int, str], spec: MiningSpec) -> Column:
    """Predicate over rows carrying ``_a{k}`` arrays: the row satisfies every term."""
    conds = [F.array_contains(F.col(_array_col(k)), F.lit(c)) for k, c in sorted(terms.items())]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def rule_rows(facts: DataFrame, edges: DataFrame, spec: MiningSpec, terms: Mapping[int, str],
              ancestors: DataFrame | None = None) -> DataFrame:
    """Fact rows covered by a rule ``{k: concept}`` (M1 when it has one term).

    The ancestor table is joined per mapped column (broadcast behind a size
    check), so the facts are never shuffled.
    """
    anc = ancestors if ancestors is not None else ancestor_sets(edges, spec.top)
    cols = facts.columns
    return with_ancestor_arrays(facts, anc, spec, terms).filter(matches(terms, spec)).select(*cols)


def top_concepts(facts: DataFrame, edges: DataFrame, spec: MiningSpec,
                 ancestors: DataFrame | None = None) -> DataFrame:
    """Concepts whose strict descendants include every value of the mapped columns.

    ``<k, concept>``; the top concept is always listed.  One job: distinct
    values per ontology, joined to the ancestor table, counted per ancestor.
    """
    anc = ancestors if ancestors is not None else ancestor_sets(edges, spec.top)
    held = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("value"))
                     for k in sorted(spec.mapping) for c in spec.mapping[k]])
    # one pass over the facts; the distinct values are written once and read for both counts
    vals = cut_lineage(facts.select(F.explode(held).alias("_it")).select("_it.k", "_it.value")
                       .filter(F.col("value").isNotNull()).distinct())
    n_vals = vals.groupBy("k").agg(F.count(F.lit(1)).alias("n_values"))
    # a value outside the taxonomy has no ancestors: then no concept but top qualifies
    covered = (
        vals.join(anc, ["k", "value"], "inner")
        .select("k", "value", F.explode("ancs").alias("concept"))
        .filter(F.col("concept") != F.col("value"))
        .groupBy("k", "concept").agg(F.count(F.lit(1)).alias("n_cov"))
    )
    tops = covered.join(n_vals, "k").filter(F.col("n_cov") == F.col("n_values")).select("k", "concept")
    always = n_vals.select("k", F.lit(spec.top).alias("concept"))
    return tops.unionByName(always).distinct()


WORD = 64


def rule_masks(anc: DataFrame, terms: DataFrame, n_words: int) -> DataFrame:
    """``<k, value, mask array<long>>``: of every value the rules whose term of ontology k it satisfies, one bit per rule.

    ``terms`` is ``<i, k, concept>`` (rule number, non-null terms); values that satisfy no term are not listed.
    """
    held = anc.select("k", "value", F.explode("ancs").alias("concept")).join(terms, ["k", "concept"])
    bit = F.expr(f"shiftleft(1L, cast(i % {WORD} as int))")
    word = lambda w: F.bit_or(F.when(F.floor(F.col("i") / WORD) == w, bit).otherwise(F.lit(0).cast("long")))
    return held.groupBy("k", "value").agg(F.array(*[word(w) for w in range(n_words)]).alias("mask"))


def _numbered(sel: DataFrame, rcols: list[str], bounded: bool) -> DataFrame:
    """``sel`` with a number ``i`` from 0 per rule."""
    if bounded:
        return sel.withColumn("i", F.row_number().over(Window.orderBy(*rcols)) - 1)
    ids = dictionary_encode(sel.select(F.struct(*rcols).alias("label")))
    return ids.select(F.col("id").alias("i"), "label.*")


def cover_counters(facts: DataFrame, edges: DataFrame, spec: MiningSpec, selected: DataFrame, *,
                   population: str = "positives", start: int = 50, floor: int = 1,
                   selected_bounded: bool = False, ancestors: DataFrame | None = None) -> DataFrame:
    """Counter per fact row: ``start`` minus the number of selected rules covering it,
    rows below ``floor`` removed.  ``<key, mapped columns, counter>``.

    Rule bitmaps: every rule is one bit.  A value's mask holds the rules whose term of its ontology it satisfies; a row
    ORs the masks of an ontology's columns with the rules that ask nothing there, ANDs over the ontologies, and counts the
    bits.  Masks are arrays of 64-bit words, as many as the rules need.  So the facts are read once and nothing is joined back;
    they are not shuffled while the masks are small enough to broadcast, else hot values are split
    (:func:`~ruleweave.operators.skew.lookup_join`).  ``selected_bounded`` says that the caller proves the selection small
    (say a top-k); otherwise rules are numbered and sized on Spark.
    """
    anc = ancestors if ancestors is not None else ancestor_sets(edges, spec.top)
    rcols = spec.rule_columns()
    sel, n_rules = materialize(selected.select(*rcols).distinct())
    n_words = max(1, -(-n_rules // WORD))
    sel = cut_lineage(_numbered(sel, rcols, selected_bounded))
    free = lambda c: F.col(c).isNull() | (F.col(c) == spec.top) if spec.top_matches_all else F.col(c).isNull()
    ks = spec.used
    # the rules that ask nothing of an ontology: one row of n_rules / 64 words each
    word = lambda c, w: F.coalesce(F.bit_or(F.when(free(c) & (F.floor(F.col("i") / WORD) == w), F.expr(
        f"shiftleft(1L, cast(i % {WORD} as int))"))), F.lit(0).cast("long"))
    open_bits = sel.agg(*[F.array(*[word(c, w) for w in range(n_words)]).alias(c) for c in rcols]).first()
    terms = sel.select("i", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.when(~free(c), F.col(c)).alias("concept"))
                                              for k, c in zip(ks, rcols)]))).filter(F.col("concept").isNotNull())
    masks, n, size = materialize_sized(rule_masks(anc, F.broadcast(terms) if selected_bounded else broadcast_if_small(terms), n_words))
    small = {k: True for k in ks} if fits(n, size) else small_parts(masks, "k")
    rows = facts.filter(_target_flag(spec)) if population == "positives" else facts
    rows = rows.select(spec.key, *spec.mapped_columns)
    split = [c for k in ks if not small.get(k, True) for c in spec.mapping[k]]
    hot = hot_keys(rows, list(dict.fromkeys(split))) if split else None
    met = []
    for k, c in zip(ks, rcols):
        names = []
        for col in spec.mapping[k]:
            name = f"_m{k}_{col}"
            side = masks.filter(F.col("k") == k).select(F.col("value").alias("_v"), F.col("mask").alias(name))
            is_small_k = small.get(k, True)
            rows = lookup_join(rows, side, col, "_v", how="left", lookup_small=is_small_k,
                               hot=None if is_small_k else hot.filter(F.col("column") == col).drop("column"))
            names.append(name)
        met.append((open_bits[c], names))
    hits = F.lit(0)
    for w in range(n_words):
        every = None
        for bits, names in met:
            one = F.lit(bits[w]).cast("long")
            for name in names:
                one = one.bitwiseOR(F.coalesce(F.get(F.col(name), w), F.lit(0).cast("long")))
            every = one if every is None else every.bitwiseAND(one)
        hits = hits + F.bit_count(every)
    counter = (F.lit(start) - hits).cast("int")
    return rows.select(spec.key, *spec.mapped_columns, counter.alias("counter")).filter(F.col("counter") >= floor)
