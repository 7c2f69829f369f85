"""Entity resolution as the reports use it: name -> code -> segment and holding."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dimensions import EXTERNAL, key_index, lookup_index
from ledgerloom.operators.grouping import first_per_key
from ledgerloom.operators.joins import join_keys
from ledgerloom.session import staged

ATTRIBUTES = ["segment", "holding"]


@dataclass(frozen=True)
class Entities:
    """Sales units (id, short_code, plant_code, segment, holding, unit_key) and the
    name mapping (name, code).

    Dimension tables are resolved against each other first, so that each fact column costs
    one join however many attributes are taken from it. The resolved tables are written
    once: every lookup shares them, and their real size, not a guess from the joins behind
    them, decides whether Spark broadcasts them or sort-merges.
    """

    units: DataFrame
    names: DataFrame
    keys: tuple[str, ...] = ("id", "short_code", "plant_code")
    unit_order: str = "unit_key"
    name_order: str = "code"

    @cached_property
    def code_index(self) -> DataFrame:
        """One row (key, segment, holding) per identifier."""
        return staged(key_index(self.units, list(self.keys), ATTRIBUTES, [self.unit_order]), "code-index")

    @cached_property
    def name_index(self) -> DataFrame:
        """One row (name, code, segment, holding) per company name."""
        names = first_per_key(self.names.select("name", "code").na.drop(subset=["name"]), ["name"], [self.name_order])
        resolved = join_keys(names, self.code_index, {"code": "key"}, "left", null_safe=False)
        return staged(resolved, "name-index")

    def by_code(self, df: DataFrame, code_col: str, **outputs: str) -> DataFrame:
        """Attributes of a code: `by_code(df, "company", segment="company_segment")`."""
        return lookup_index(df, code_col, self.code_index, outputs)

    def by_name(self, df: DataFrame, name_col: str, **outputs: str) -> DataFrame:
        """Code and attributes of a name: `by_name(df, "party", code="party_code", segment=...)`."""
        return lookup_index(df, name_col, self.name_index, outputs, key="name")


def first_known(*cols: str):
    """First code that is neither missing nor 'External'."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit(EXTERNAL)) for c in cols], F.lit(EXTERNAL))
