import pytest
from pyspark.sql import functions as F

from tidemark import registry as R

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,rows", [
    ("stg_users", 1500), ("stg_wallets", 6470), ("stg_transactions", 15000),
    ("latest_per_key", 45832), ("cdc_compact", 120), ("cdc_merge", 120),
    ("cdc_insert_only_merge", 54701), ("scd2_apply", 300), ("api_flatten", 13519),
    ("api_quarantine", 150),
])
def test_stated_counts(spark, name, rows):
    assert R.REGISTRY[name](spark, SF).count() == rows


def test_as_of_join_facts_without_version(spark):
    out = R.q_as_of_join(spark, SF)
    assert out.count() == 1981
    assert out.where(F.col("state").isNull()).count() == 40


def test_negative_balances_fail_the_range_check(spark):
    res = {r.unique_id: r.failures for r in R.q_dq_non_negative(spark, SF).collect()}
    assert res["range_customer_c_acctbal"] == 122
    assert res["assert_transaction_usd_value_non_negative"] == 0


def test_reconcile_has_exactly_25_two_version_users(spark):
    got = {r.versions: r.users for r in R.q_scd2_reconcile(spark, SF).collect()}
    assert got == {1: 1475, 2: 25}
