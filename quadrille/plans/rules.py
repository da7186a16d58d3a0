"""Ordered rules: each reads the statements so far and adds its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.plans import patterns
from quadrille.store import written


@dataclass(frozen=True)
class Rule:
    """``where`` gives bindings of the statements; ``templates`` what each adds."""

    name: str
    where: Callable[[DataFrame], DataFrame]
    templates: tuple

    def __call__(self, quads: DataFrame) -> DataFrame:
        return patterns.construct(self.where(quads), *self.templates)


def apply_rules(quads: DataFrame, rules: Iterable[Rule | Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``quads``, a set of statements, and what the rules add in order, as a set; a rule sees what earlier ones added.

    Only what a rule adds is written down, and only that is compared with the statements of the same predicates; the statements themselves aren't copied.
    """
    for rule in rules:
        made = written(rule(quads), "made")
        constant = isinstance(rule, Rule) and all(isinstance(p, str) and not p.startswith("?") for _, p, *_ in rule.templates)
        predicates = sorted({p for _, p, *_ in rule.templates}) if constant else []
        alike = terms.holding(quads, predicates).where(F.col("p").isin(predicates)) if constant else quads
        quads = patterns.union(quads, written(minus(made, common(alike, made)), "added"))
    return quads


def common(quads: DataFrame, others: DataFrame) -> DataFrame:
    """Statements of ``quads`` that are among ``others``; graphs that are null agree."""
    return _met(quads, others, "left_semi")


def until_stable(quads: DataFrame, rules: Iterable[Callable[[DataFrame], DataFrame]], max_rounds: int = 8) -> DataFrame:
    """Deletion rules: all read the same statements, what they return goes, again until nothing goes or ``max_rounds`` are over."""
    rules, n = list(rules), quads.count()
    for _ in range(max_rounds):
        gone = patterns.union(*(rule(quads) for rule in rules)).select(*terms.KEY).distinct()
        quads = written(minus(quads, gone), "stable")
        n, before = quads.count(), n
        if n == before:
            break
    return quads


def minus(quads: DataFrame, gone: DataFrame) -> DataFrame:
    """Set difference on whole statements; graphs that are null agree."""
    return _met(quads, gone, "left_anti")


def _met(quads: DataFrame, others: DataFrame, how: str) -> DataFrame:
    others = others.select(*(others[c].alias(f"__{c}") for c in terms.KEY))
    on = quads["g"].eqNullSafe(others["__g"])
    for c in terms.KEY[1:]:
        on = on & (quads[c] == others[f"__{c}"])
    return quads.join(others, on, how)


def same_statements(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of statements are equal."""
    return minus(a, b).isEmpty() and minus(b, a).isEmpty()
