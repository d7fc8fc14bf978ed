"""Writers of results: folders that many tasks fill at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orevein.operators import rules as R, trees as T


def rules(df: DataFrame, path: str) -> None:
    """Text lines ``antecedent  | consequent  | count | confidence``."""
    R.rule_lines(df).write.text(path)


def itemsets(df: DataFrame, path: str) -> None:
    """Text lines ``items  |  {} | count | -1`` of the sets with more than one item."""
    R.itemset_lines(df).write.text(path)


def weights(df: DataFrame, path: str) -> None:
    """All weightings ``(doc_id, stem_id, scheme, w)``, one folder per scheme, as CSV triplets."""
    df.select("scheme", "doc_id", "stem_id", "w").write.partitionBy("scheme").csv(path)


def vocabulary(df: DataFrame, path: str) -> None:
    df.select("stem_id", "stem").write.csv(path)


def class_map(df: DataFrame, path: str) -> None:
    df.select("doc_id", "topic").write.csv(path)


def assignment(df: DataFrame, path: str) -> None:
    """Clusters ``(id, k)``."""
    df.select("id", "k").write.csv(path)


def predictions(df: DataFrame, path: str) -> None:
    df.select("label", "pred").write.csv(path)


def tree_predictions(df: DataFrame, path: str) -> None:
    """Votes with their row key, one folder per tree."""
    df.select("row_id", "label", "pred", "tree").write.partitionBy("tree").parquet(path)


def model(df: DataFrame, path: str) -> None:
    """Nodes of all trees in folders by tree and depth, the order in which they are read."""
    columns = ["node", "is_leaf", "a", "split", "gini", "label", "n", "hist", "tree", "depth"]
    T.write_model(df.select(*columns), path, "tree", "depth")
