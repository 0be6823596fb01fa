from __future__ import annotations

import uuid

import pytest

from eventmart.functions.privacy import mask, register_functions, row_visible
from eventmart.plans.privacy_views import create_privacy_view, privacy_view
from tests.conftest import rows

ALL_TIERS = "analyst_all_tiers"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("1", "jo@x.org", "UK"), ("2", "no-mail", "US"), ("3", None, "IN"), ("4", "z@y.org", None)],
        "user_id string, email string, country string",
    )


@pytest.mark.parametrize(
    ("roles", "kind", "expected"),
    [
        (["admin", "analyst_UK"], "email", ["jo@x.org", "no-mail", None, "z@y.org"]),
        (["analyst_UK"], "email", ["j***@x.org", "n***", None, "z***@y.org"]),
        (["analyst_US"], "text", ["j***", "n***", None, "z***"]),
        ([ALL_TIERS], "email", ["*****@****.***"] * 4),
        ([], "text", ["*****"] * 4),
    ],
)
def test_mask(spark, people, roles, kind, expected):
    assert [r[0] for r in people.orderBy("user_id").select(mask("email", kind, roles)).collect()] == expected
    register_functions(spark)
    people.createOrReplaceTempView("people")
    held = f"cast(array({','.join(repr(r) for r in roles)}) as array<string>)"
    sql = spark.sql(f"select data_mask(email, '{kind}', {held}) from people order by user_id")
    assert [r[0] for r in sql.collect()] == expected


@pytest.mark.parametrize(
    ("roles", "seen"),
    [
        (["admin"], "1234"),
        (["analyst_UK", ALL_TIERS], "1"),
        (["analyst_US", "analyst_premium_tiers"], "2"),
        (["analyst_UK", "analyst_US", "analyst_business_tiers"], "12"),
        (["analyst_UK"], ""),
        ([ALL_TIERS], ""),
        ([], ""),
    ],
)
def test_visibility(spark, people, roles, seen):
    assert "".join(sorted(r.user_id for r in people.filter(row_visible("country", roles)).collect())) == seen
    register_functions(spark)
    people.createOrReplaceTempView("people")
    held = f"cast(array({','.join(repr(r) for r in roles)}) as array<string>)"
    sql = spark.sql(f"select user_id from people where row_filter(country, {held})")
    assert "".join(sorted(r[0] for r in sql.collect())) == seen


def test_lasting_view_equals_frame(spark, people):
    tag = uuid.uuid4().hex[:8]
    people.write.saveAsTable(f"people_{tag}")
    for roles in ([], ["admin"], ["analyst_UK", ALL_TIERS]):
        create_privacy_view(spark, f"people_{tag}", f"vw_{tag}", ["user_id", "email"], roles)
        assert rows(spark.table(f"vw_{tag}")) == rows(privacy_view(people, ["user_id", "email"], roles))


def test_masked_country_is_still_filtered(people):
    got = privacy_view(people, ["country"], ["analyst_UK", ALL_TIERS])
    assert rows(got) == [("1", "jo@x.org", "U***")]
