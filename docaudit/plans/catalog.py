"""All queries of the core by name, with their SQL."""

from __future__ import annotations

from docaudit.operators import units
from docaudit.plans import assessments, cards, shapes  # noqa: F401  (they register their queries)
from docaudit.plans.queries import QUERIES, SQL, flagship

__all__ = ["flagship", "oracle_sql", "queries"]

IDENTITIES = """
    SELECT source, n_rows, CASE WHEN n_rows > 0 THEN list_sort(o)[1].u END AS unit_recorded, CASE WHEN n_rows > 0 THEN round(list_sort(o)[1].r, 6) END AS residual,
           CASE WHEN n_rows > 0 THEN list_sort(o)[2].r - list_sort(o)[1].r > 0.05 END AS is_unique
    FROM (SELECT source, n_rows, [{'r': abs(m), 'u': 'characters'}, {'r': abs(m + ln(1000)), 'u': 'thousands'}, {'r': abs(m + ln(12)), 'u': 'dozens'}] AS o
          FROM (SELECT source, avg(CASE WHEN n_chars > 0 AND length(text) > 0 THEN ln(n_chars) - ln(length(text)) END) AS m,
                       count(CASE WHEN n_chars > 0 AND length(text) > 0 THEN 1 END) AS n_rows FROM documents GROUP BY source))
"""


def queries():
    return QUERIES | {"p3_quantities": units.p3_quantities, "p3_found": units.p3_found, "p3_identities": units.p3_identities}


def oracle_sql():
    return SQL | {"p3_identities": IDENTITIES}
