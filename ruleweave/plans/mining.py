"""One mining run: rules, selection, summary and cover counters over shared intermediates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.operators import hierarchy as H
from ruleweave.operators import rules as R
from ruleweave.operators.sizing import cut_lineage
from ruleweave.sources.ntriples import read_taxonomy_files
from ruleweave.sources.tables import read_delimited


class Mining:
    """Facts and taxonomy edges under a spec; the closure and the mined rules are computed once and shared."""

    def __init__(self, facts: DataFrame, edges: DataFrame, spec: R.MiningSpec):
        self.facts, self.edges, self.spec = facts, edges, spec

    @cached_property
    def ancestors(self) -> DataFrame:
        return H.ancestor_sets(self.edges, self.spec.top)

    @cached_property
    def rules(self) -> DataFrame:
        """All rules with their scores, written once to the shared folder."""
        return cut_lineage(R.mine_rules(self.facts, self.edges, self.spec, self.ancestors))

    def selected(self, k: int | None = 10) -> DataFrame:
        """The ``k`` best rules (all of them, sorted, if None): from the mined rules if they are there, else by bounded search."""
        if k is None or "rules" in self.__dict__:
            return R.select_rules(self.rules, self.spec, k)
        return R.mine_top_rules(self.facts, self.edges, self.spec, k, self.ancestors)

    def summary(self) -> DataFrame:
        return R.rule_summary(self.rules)

    def counters(self, selected: DataFrame, population: str = "positives", start: int = 50, floor: int = 1,
                 bounded: bool = False) -> DataFrame:
        """Cover counters of the selected rules (see :func:`ruleweave.operators.rules.cover_counters`)."""
        return R.cover_counters(self.facts, self.edges, self.spec, selected, population=population, start=start,
                                floor=floor, selected_bounded=bounded, ancestors=self.ancestors)


def run_mining(spark: SparkSession, facts_path: str, taxonomy_paths: Sequence[str], spec: R.MiningSpec,
               positive: str = "true", distinct: bool = False, **reader) -> Mining:
    """A run over files: delimited facts with a header, one N-Triples file per ontology (position = ontology id).

    A row is positive when its target column equals ``positive``; a null is not.  ``distinct`` counts equal
    rows once.  ``reader`` goes to :func:`ruleweave.sources.tables.read_delimited`.
    """
    target = F.coalesce(F.col(spec.target) == positive, F.lit(False))
    facts = read_delimited(spark, facts_path, **reader).withColumn(spec.target, target)
    if distinct:
        facts = R.distinct_rows(facts, spec)
    edges = H.subclass_edges(read_taxonomy_files(spark, list(taxonomy_paths)))
    return Mining(facts, edges, spec)
