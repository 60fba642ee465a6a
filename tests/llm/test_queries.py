"""The registered queries against their SQL oracles on the smallest tables."""

import pytest

from screenloom.llm import queries
from tests.compare import same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, name):
    assert not same(spark, queries.QUERIES[name], queries.ORACLES[name], sf)


def test_containers_hold_every_token(spark, sf):
    rows = queries.p7_pack_2048(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert rows.select("doc_id").distinct().count() == docs
    assert rows.groupBy("container").sum("n_tokens").where("container IS NOT NULL AND `sum(n_tokens)` > 2048").count() == 0


def test_subject_labels_mostly_agree(spark):
    """Held-out accuracy: hand labels, a tenth of which are wrong or incomplete."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/subject_labels.parquet").selectExpr("doc_id", "lower(trim(subject)) AS subject").distinct()
    found = queries.p9_found(spark, d)
    hits, all_ = labels.join(found, ["doc_id", "subject"]).count(), labels.count()
    assert hits >= 0.9 * all_
