"""Near copies by both indexes: SimHash fingerprints linked at two bits, joined with verified Jaccard links.

A class is what is reachable over links of either kind, so an edited copy that its fingerprint misses
is still found by the bands, and no link of the fingerprints is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.graph import components
from holdfast.llm.minhash import SIMILARITY, first_of_each, near_copy_classes
from holdfast.llm.simhash import fingerprints, linked_fingerprints
from holdfast.session import materialize


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``_id, _key, class`` of each distinct (id, text): reachable over links of fingerprints or of verified Jaccard."""
    prints = fingerprints(docs, id_col, text_col)
    roots = prints.join(linked_fingerprints(prints).select("fp", "root"), "fp").select("_id", "_key", "root")
    alike = near_copy_classes(docs, similarity, id_col=id_col, text_col=text_col)
    both = materialize(
        alike.dropDuplicates(["_id", "_key"]).join(roots.dropDuplicates(["_id", "_key"]), ["_id", "_key"]),
        "both-classes",
    )
    spans = both.groupBy("root").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    ties = both.join(spans.where("low <> high"), "root").select("class", "low")
    tied = components(ties).toDF("class", "joined")
    return both.join(tied, "class", "left").select(
        "_id", "_key", F.coalesce("joined", "class").alias("class")
    )


def one_of_near(
    docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each class of :func:`near_classes`, the one with the smallest id; all columns stay."""
    return first_of_each(docs, near_classes(docs, similarity, id_col, text_col), id_col, text_col)
