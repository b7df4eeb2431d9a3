"""Truck/logistics grading of a parcel as one Column: no UDF, no Python per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelgrid.functions.geometry import record
from parcelgrid.types import CLASSIFICATION_TYPE

# The keywords of the grading rules, in the order in which they are tried.
# Order decides only which text is reported when two match at one position.
STRONG_KEYWORDS = [
    r"\bTRUCK\s*STOP\b",
    r"\bTRUCKSTOP\b",
    r"\bTRUCKING\b",
    r"\bTRUCK\s*TERMINAL\b",
    r"\bFREIGHT\b",
    r"\bLOGISTICS\b",
    r"\bDISTRIBUTION\b",
    r"\bWAREHOUS",
    r"\bTRANSLOAD\b",
    r"\bINTERMODAL\b",
    r"\bTERMINAL\b",
    r"\bTRAVEL\s*CENTER\b",
    r"\bTRAVEL\s*PLAZA\b",
    r"\bTRAVEL\s*STOP\b",
    r"\bWEIGH\s*STATION\b",
    r"\bTRUCK\s*WASH\b",
    r"\bPILOT\b",
    r"\bFLYING\s*J\b",
    r"\bLOVE'?S\b",
    r"\bPETRO\b",
    r"\bTA\s*TRAVEL\b",
    r"\bIOWA\s*80\b",
    r"\bFEDEX\b",
    r"\bUPS\b",
]
WEAK_KEYWORDS = [r"\bFUEL\b", r"\bTRAVEL\b", r"\bPLAZA\b", r"\bGAS\b", r"\bSTATION\b"]
INDUSTRIAL_ZONING = ["industrial", "manufacturing", "warehouse"]
SPECIAL_COMMERCIAL = "special commercial"
TEXT_FIELDS = ["owner", "address", "struct", "zoning_subtype"]
CODE_FIELDS = ["lbcs_activity", "lbcs_function"]

# i: any case; U: white space, case and word borders as Unicode defines them.
_FLAGS = "(?iU)"
# Four characters that are an integer from 3000 to 4999.
_CODE_PATTERN = "^[34][0-9]{3}$"


def _first_match(text: Column, keywords: list[str]) -> Column:
    return F.regexp_extract(text, _FLAGS + "|".join(keywords), 0)


def _strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def _grade(flag: bool, confidence: Column | str, reasons: Column) -> Column:
    level = confidence if isinstance(confidence, Column) else F.lit(confidence)
    return record(truck_flag=F.lit(flag), confidence=level, reasons=reasons).cast(
        CLASSIFICATION_TYPE
    )


def _signals(attrs: Mapping[str, Column]) -> Column:
    """Everything the decision reads, each pattern searched once."""

    def attr(name: str) -> Column:
        return attrs.get(name, F.lit(None)).cast("string")

    text = F.concat_ws(" ", *(F.coalesce(attr(name), F.lit("")) for name in TEXT_FIELDS))
    code_reason = F.coalesce(
        *(
            F.when(
                F.substring(attr(name), 1, 4).rlike(_CODE_PATTERN),
                F.concat(F.lit(f"{name}="), attr(name)),
            )
            for name in CODE_FIELDS
        )
    )
    industrial = F.coalesce(
        F.lower(_strip(attr("zoning_type"))).isin(INDUSTRIAL_ZONING), F.lit(False)
    )
    special = F.lower(attr("zoning_subtype")).contains(SPECIAL_COMMERCIAL)
    return record(
        strong=_first_match(text, STRONG_KEYWORDS),
        weak=_first_match(text, WEAK_KEYWORDS),
        zoning=F.when(industrial, F.concat(F.lit("zoning: "), attr("zoning_type"))),
        code=code_reason,
        special=F.coalesce(special, F.lit(False)),
    )


def _decide(s: Column) -> Column:
    strong, zoning, code = s["strong"] != "", s["zoning"].isNotNull(), s["code"].isNotNull()
    reasons = F.array_compact(
        F.array(
            F.when(strong, F.concat(F.lit("keyword: '"), s["strong"], F.lit("'"))),
            s["zoning"],
            s["code"],
        )
    )
    weak_reason = F.concat(F.lit("special commercial + weak keyword: '"), s["weak"], F.lit("'"))
    return (
        F.when(
            strong,
            _grade(True, F.when(zoning | code, "high").otherwise("medium"), reasons),
        )
        .when(
            zoning | code,
            _grade(True, F.when(zoning & code, "high").otherwise("medium"), reasons),
        )
        .when(s["special"] & (s["weak"] != ""), _grade(True, "low", F.array(weak_reason)))
        .otherwise(_grade(False, "high", F.array(F.lit("no truck signal"))))
    )


def classify_parcel(
    attrs: Mapping[str, Column],
    parcel_matched: Column | None = None,
    lookup_error: Column | None = None,
) -> Column:
    """``STRUCT<truck_flag, confidence, reasons>`` for one parcel.

    ``attrs`` maps attribute names to columns; a missing name counts as NULL.
    ``lookup_error``, where not NULL, wins over everything; then ``parcel_matched`` =
    false; then the rules.
    """
    # The signals go through an array of one, so that every branch reads the same value
    # and no pattern is searched twice.
    graded = F.transform(F.array(_signals(attrs)), _decide)[0]
    if parcel_matched is not None:
        graded = F.when(
            F.coalesce(parcel_matched, F.lit(False)), graded
        ).otherwise(_grade(False, "high", F.array(F.lit("no parcel found"))))
    if lookup_error is not None:
        graded = F.when(
            lookup_error.isNotNull(), _grade(False, "error", F.array(lookup_error))
        ).otherwise(graded)
    return graded
