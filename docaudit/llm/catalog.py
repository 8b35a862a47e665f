"""All queries of the subpackage by name; none of them can be put in SQL (see the README)."""

from __future__ import annotations

from docaudit.llm import blocks, encoding, language, names, packing, quality, splitting


def queries():
    return {"p1_segments": language.p1_segments, "p1_languages": language.p1_languages, "p1_found": language.p1_found, "p2_institutions": names.p2_institutions, "p2_found": names.p2_found, "p4_lines": blocks.p4_lines, "p4_found": blocks.p4_found, "p5_found": splitting.p5_found, "p6_ids": encoding.p6_ids, "p7_containers": packing.p7_containers, "p8_statistics": quality.p8_statistics, "p8_found": quality.p8_found}


def oracle_sql():
    return {}
