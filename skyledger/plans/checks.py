"""Constraint reports: booking model and history layer (keys, references, NOT NULL, lengths).

Each report declares its constraints and reads every table once
(`operators.quality.violation_report`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import Constraints, schema_rules, violation_report
from ..schemas import FOREIGN_KEYS, OLTP, PRIMARY_KEYS, TEXT_LIMITS


def booking_constraints(t: Mapping[str, DataFrame]) -> Constraints:
    """Declared constraints of the booking-model tables present in `t`."""
    c = Constraints()
    for name, key in PRIMARY_KEYS.items():
        if name in t:
            c.keys.append((f"pk:{name}", name, key))
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        if child in t and parent in t:
            c.references.append((f"fk:{child}.{'+'.join(ccols)}", child, ccols, parent, pcols))
    for name, schema in OLTP.items():
        if name in t:
            for rule, broken in schema_rules(schema, t[name].columns, TEXT_LIMITS.get(name)).items():
                c.rules.append((f"col:{name}.{rule}", name, broken))
    return c


def constraint_report(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check of the booking model: (check_name, violations)."""
    return violation_report(t, booking_constraints(t))


def vault_constraints() -> Constraints:
    """History layer: unique hash keys and ids, unique (parent, load_date) per
    satellite, every reference resolving to its hub / link, and the columns that
    every row must fill (ids, keys, lineage)."""
    from . import vault as V

    def id_col(name):
        return V.HUB_BY_NAME[name].id_col if name in V.HUB_BY_NAME else V.LINK_BY_NAME[name].id_col

    c = Constraints()
    required: dict[str, list[str]] = {}
    for h in V.HUBS:
        c.keys += [(f"pk:{h.name}.{h.hash_col}", h.name, [h.hash_col]), (f"pk:{h.name}.{h.id_col}", h.name, [h.id_col])]
        required[h.name] = [h.id_col, h.hash_col, h.key]
    for lk in V.LINKS:
        c.keys += [(f"pk:{lk.name}.{lk.hash_col}", lk.name, [lk.hash_col]),
                   (f"pk:{lk.name}.{lk.id_col}", lk.name, [lk.id_col])]
        for out, ref in lk.refs:
            target = ref.split(":")[0]
            c.references.append((f"fk:{lk.name}.{out}", lk.name, [out], target, [id_col(target)]))
        required[lk.name] = [lk.id_col, lk.hash_col, *[out for out, _ in lk.refs], *lk.degenerate]
    for s in V.SATELLITES:
        pid = id_col(s.parent)
        c.keys.append((f"pk:{s.name}.{pid}+load_date", s.name, [pid, "load_date"]))
        c.references.append((f"fk:{s.name}.{pid}", s.name, [pid], s.parent, [pid]))
        required[s.name] = [pid, "hash_diff"]
    for name, cols in required.items():
        c.rules += [(f"col:{name}.{x}_null", name, F.col(x).isNull()) for x in [*cols, *V.LINEAGE_COLS]]
    return c


def vault_report(v: Mapping[str, DataFrame]) -> DataFrame:
    """One row per history-layer check: (check_name, violations)."""
    return violation_report(v, vault_constraints())
