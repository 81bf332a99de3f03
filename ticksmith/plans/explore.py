"""The exploration script's flow as one plan.

Documents -> fact rows with the ``datetime`` column name (A17) and the
deduplicated dimension (A23), each stamped (A20), plus their first rows in
a fixed order (A26).  Documents the script would fail on (a missing
``meta`` next to bars, or any broken entry) are refused as a whole and
returned separately instead of stopping the run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ticksmith.functions.stamps import RunStamp
from ticksmith.operators import flatten as fl


@dataclass
class Exploration:
    fact: DataFrame
    dim: DataFrame
    rejected: DataFrame

    def fact_head(self, n: int = 5) -> DataFrame:
        return fl.preview(self.fact, n).drop("doc_id", "bar_idx")

    def dim_head(self, n: int = 5) -> DataFrame:
        return self.dim.orderBy("doc_id", "symbol").limit(n).drop("doc_id")


def explore_documents(docs: DataFrame, stamp: RunStamp | None = None) -> Exploration:
    stamp = stamp or RunStamp.now()
    parsed = fl.parse_documents(docs, mode=fl.EXPLORE)
    entries = fl.entry_rows(parsed)
    fact = fl.fact_rows(entries, stamp.extracted_at_utc, keep=("doc_id",), date_column="datetime",
                        with_index=True)
    dim = fl.dim_distinct(entries, stamp.extracted_at_utc, keep=("doc_id",))
    return Exploration(fact=fact, dim=dim, rejected=fl.rejected(parsed))
