"""Taxon lists of subjects. The two rules differ on purpose: screening is strict, read classification splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "N/A"


def only_target(taxids: Column, target: Column) -> Column:
    """Screening: the subject's distinct taxa are exactly the target; an unknown or mixed list is off target."""
    return F.array_distinct(F.split(taxids, ";")) == F.array(target)


def scope_list(taxids: Column) -> Column:
    """Read classification: taxa separated by `;` or `,`, blanks trimmed."""
    return F.transform(F.split(F.replace(taxids, F.lit(","), F.lit(";")), ";"), lambda x: F.trim(x))


def in_scope(taxids: Column, scope: Column) -> Column:
    """Some taxon of the subject is in `scope`; never for an unknown list."""
    return (taxids != UNKNOWN) & F.arrays_overlap(scope_list(taxids), scope)


def out_of_scope(taxids: Column, scope: Column) -> Column:
    """Some taxon of the subject is outside `scope`, or the list is unknown."""
    return (taxids == UNKNOWN) | F.exists(scope_list(taxids), lambda x: ~F.array_contains(scope, x))


def malformed(taxids: Column) -> Column:
    return taxids.isNull() | ((taxids != UNKNOWN) & F.exists(scope_list(taxids), lambda x: ~x.rlike("^[1-9][0-9]*$")))


def canonical_order(taxid: Column) -> list[Column]:
    """Numeric order of decimal strings of any length."""
    return [F.length(taxid), taxid]
