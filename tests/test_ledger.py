"""Edge cases of version selection, order values and the cohort."""

import datetime as dt

import pytest
from ledgers import AS_OF, at, document, ledger, line, rate, rows

from clientele import schemas
from clientele.functions.money import half_even, half_up
from clientele.operators import cohort, orders, versions
from pyspark.sql import functions as F

DAY = "2024-01-10"


@pytest.fixture(scope="module")
def book(spark):
    """One ledger that holds the order edge cases, told apart by order number."""
    lines = [
        line(1, 10, 100),                                        # plain
        line(2, 20, 100), line(3, 21, -30, order=20), line(4, 22, -20, order=20),  # two return days
        line(5, 30, 100), line(6, 31, -100, order=30),           # fully refunded
        line(7, 40, 100),                                        # no rate that day
        line(8, 50, 100), line(9, 51, -40, order=50),            # return without a rate
        line(10, 60, 70, item=None), line(11, 60, 70, item="P1"),
        line(12, 60, 5, item="p1"), line(13, 60, 0),             # only the small p counts
        line(14, 70, 10), line(14, 70, 20, second=0.9), line(14, 70, 99, day="2024-01-11"),
        line(15, None, 50), line(None, 10, 50),                  # keys that match nothing
        line(16, 80, 10, discount=2.345),
        line(17, 90, 40), line(18, 91, -5, order=None),          # a return of no order
    ]
    documents = [
        document(10), document(20), document(21, day="2024-02-01"), document(22, day="2024-02-02"),
        document(30), document(31, day="2024-02-01"), document(40, day="2024-01-13"), document(50),
        document(51, day="2024-01-13"), document(60), document(70), document(80, currency="EUR"),
        document(90), document(90, user="b", changed="2024-03-01"), document(91, day="2024-02-01"),
        (95, None, "a", "DKK", at(DAY), at(DAY)),
    ]
    rates = [rate(DAY), rate("2024-02-01"), rate("2024-02-02"), rate(DAY, "EUR", 0.134)]
    return ledger(spark, lines, documents, rates)


@pytest.fixture(scope="module")
def values(book):
    out = {}
    for r in orders.order_values(*book).collect():
        out.setdefault(r["OrderId"], []).append(r["order_value"])
    return {k: sorted(v, key=repr) for k, v in out.items()}


@pytest.mark.parametrize("order, expected", [
    (10, [100.0]), (20, [70.0, 80.0]), (30, [0.0]), (40, [None]), (50, [100.0]), (60, [5.0]),
    (70, [30.0]),      # both rows of the first second
    (80, [57.16]),     # 10 - 2.345 rounds up to 7.66; over 0.134 that is 57.164
    (90, [40.0])])
def test_order_value(values, order, expected):
    assert values[order] == expected


def test_no_other_orders(values):
    assert set(values) == {10, 20, 30, 40, 50, 60, 70, 80, 90}


def test_first_document_version_names_the_customer(book):
    found = orders.order_values(*book).where("OrderId = 90").collect()
    assert [r["userId"] for r in found] == ["a"]


def test_total_returns(book):
    found = orders.order_values(*book, returns="total").where("OrderId IN (20, 50)")
    assert rows(found.select("OrderId", "order_value")) == [(20, 50.0), (50, 100.0)]


def test_returns_of_no_order_stay_in_the_return_list(book):
    moves = orders.movements(book.lines, book.documents)
    assert (None, dt.date(2024, 2, 1), "DKK", -5.0) in rows(orders.local_returns(moves))


def test_unknown_return_mode(book):
    with pytest.raises(ValueError):
        orders.order_values(*book, returns="weekly")


def test_restricting_to_customers_equals_filtering(spark, book):
    some = spark.createDataFrame([("a",), (None,)], "userId string")
    narrow = orders.order_values(*book, customers=some)
    assert rows(narrow) == rows(orders.order_values(*book).where("userId = 'a'"))


@pytest.mark.parametrize("which, kept", [("first", ["x", "y"]), ("last", ["z"])])
def test_version_ties_within_a_second(spark, which, kept):
    df = spark.createDataFrame(
        [(1, "x", at(DAY, 0.1)), (1, "y", at(DAY, 0.9)), (1, "z", at(DAY, 2)),
         (None, "n", at(DAY)), (2, "t", None)], "k long, v string, __ts_ms timestamp")
    assert sorted(r["v"] for r in versions.pick_versions(df, "k", which).collect()) == kept
    assert versions.pick_versions(df, "k", which, ties="one").count() == 1


def test_versions_of_one_hot_key(spark):
    """A third of all rows under one key, all in different seconds."""
    df = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS k", "id AS v", "timestamp_seconds(id) AS __ts_ms")
    first = versions.pick_versions(df, "k", "first")
    assert first.count() == df.select("k").distinct().count()
    assert first.where("k = 0").collect()[0]["v"] == 0
    assert versions.pick_versions(df, "k", "last").where("k = 0").collect()[0]["v"] == 2997


def test_bad_version_arguments(spark):
    df = spark.createDataFrame([(1, at(DAY))], "k long, __ts_ms timestamp")
    with pytest.raises(ValueError):
        versions.pick_versions(df, "k", "middle")
    with pytest.raises(ValueError):
        versions.pick_versions(df, "k", ties="some")


def _orders(spark, data):
    return spark.createDataFrame(
        [(k, u, dt.date.fromisoformat(d), v) for k, u, d, v in data],
        "OrderId long, userId string, order_date date, order_value double")


@pytest.fixture(scope="module")
def cohort_values(spark):
    return _orders(spark, [
        (1, "two_years", "2020-01-01", 5.0), (2, "two_years", "2022-06-15", 5.0),
        (3, "just_in", "2020-01-01", 5.0), (4, "just_in", "2022-06-16", 5.0),
        (5, "refunded", "2024-01-01", 0.0), (6, "refunded", "2024-01-02", 9.0),
        (7, "once", "2024-01-01", 5.0), (8, "no_rate", "2024-01-01", 5.0),
        (9, "no_rate", "2024-01-02", None), (10, "negative", "2024-01-01", 5.0),
        (11, "negative", "2024-01-02", -1.0),
        (12, "twins", "2024-01-01", 5.0), (13, "twins", "2024-01-01", 5.0),
        (14, "repeat", "2024-01-01", 5.0), (14, "repeat", "2024-01-01", 5.0),
        (15, None, "2024-01-01", 5.0), (16, None, "2024-01-02", 5.0)])


def test_eligibility(cohort_values):
    found = {r["userId"] for r in cohort.eligible_customers(cohort_values, AS_OF).collect()}
    assert found == {"just_in", "refunded", "twins", "repeat"}


def test_training_rows(cohort_values):
    found = rows(cohort.training_rows(cohort_values, AS_OF).where(
        "userId IN ('refunded', 'twins', 'repeat')"))
    day = dt.date(2024, 1, 1)
    assert found == [("refunded", dt.date(2024, 1, 2), 9.0), ("repeat", day, 5.0),
                     ("twins", day, 5.0), ("twins", day, 5.0)]


def test_newest_first(cohort_values):
    days = [r["order_date"] for r in
            cohort.training_rows(cohort_values, AS_OF, newest_first=True).collect()]
    assert days == sorted(days, reverse=True)


@pytest.mark.parametrize("frequency", ["D", "W", "M"])
def test_profiles_equal_the_composed_operators(cohort_values, frequency):
    from clientele.operators.rfm import purchase_periods
    train = cohort.training_rows(cohort_values, AS_OF)
    composed = purchase_periods(train, frequency)
    profiles = cohort.customer_profiles(cohort_values, frequency, AS_OF)
    assert rows(profiles) == rows(composed.select(profiles.columns))


@pytest.mark.parametrize("frequency", ["D", "W", "M"])
def test_orders_without_a_date_do_not_count(spark, frequency):
    from clientele.operators.rfm import purchase_periods
    dated = _orders(spark, [(1, "a", "2024-01-01", 5.0), (3, "b", "2024-01-01", 5.0),
                            (4, "b", "2024-02-01", 5.0)])
    values = dated.union(spark.createDataFrame([(2, "a", None, 7.0)], dated.schema))
    train = cohort.training_rows(values, AS_OF)
    profiles = cohort.customer_profiles(values, frequency, AS_OF)
    assert {r["userId"] for r in train.collect()} == {"b"}
    assert rows(profiles) == rows(purchase_periods(train, frequency).select(profiles.columns))


def test_values_below_a_cent_are_kept(spark):
    from clientele.operators.rfm import repeat_buyers, rfm_summary
    values = _orders(spark, [(i, "a", f"2024-0{i}-01", 0.004) for i in (1, 2, 3)]
                     + [(9, "b", "2024-01-01", 0.0149), (10, "b", "2024-02-01", 0.0149)])
    train = cohort.training_rows(values, AS_OF)
    scored = {r["userId"]: r for r in repeat_buyers(rfm_summary(train, "M")).collect()}
    assert scored["a"]["monetary_value"] == pytest.approx(0.004)
    assert scored["b"]["monetary_value"] == pytest.approx(0.0149)
    revenue = {r["userId"]: r["current_total_revenue"] for r in cohort.customer_revenue(train).collect()}
    assert revenue == {"a": pytest.approx(0.012), "b": pytest.approx(0.0298)}
    profiles = {r["userId"]: float(r["revenue"]) for r in cohort.customer_profiles(values, "M", AS_OF).collect()}
    assert profiles == revenue


def test_changed_customers(spark):
    day = AS_OF - dt.timedelta(days=1)
    docs = [document(1, "yesterday", "2020-01-01", changed=day), document(2, "today", AS_OF),
            document(3, "older", AS_OF - dt.timedelta(days=2)), document(4, "today", AS_OF)]
    df = ledger(spark, [line(1, 1, 1)], docs, [rate(DAY)]).documents
    assert rows(cohort.changed_customers(df, AS_OF)) == [("today",), ("yesterday",)]


def test_rounding(spark):
    df = spark.createDataFrame([(2.345,), (-2.345,), (0.125,), (2.5,)], "x double")
    up = [r[0] for r in df.select(half_up(F.col("x"))).collect()]
    assert up[1] == -up[0] and up[2] == 0.13
    even = [r[0] for r in df.select(half_even(F.col("x"))).collect()]
    assert even[2] == 0.12 and [r[0] for r in df.select(half_even(F.col("x"), 0)).collect()][3] == 2.0


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_few_and_many_customers_have_the_same_orders(spark, book, monkeypatch, share):
    """One way finds the customers' part of the ledger first, the other takes all amounts."""
    monkeypatch.setattr(orders, "FEW", share)
    some = spark.createDataFrame([("a",), ("b",), ("nobody",)], "userId string")
    whole = orders.order_values(*book).where("userId IN ('a', 'b')")
    assert rows(whole) and rows(orders.order_values(*book, customers=some)) == rows(whole)


def test_given_amounts_stand_for_the_lines(spark, book):
    """Amounts that another step has taken from the ledger are not computed again."""
    some = spark.createDataFrame([("a",), ("b",), ("nobody",)], "userId string")
    moves = orders.movements(book.lines, book.documents)
    none = book._replace(lines=book.lines.where("Id < 0"))
    for customers in (None, some):
        expected = rows(orders.order_values(*book, customers=customers))
        assert expected and rows(orders.order_values(*none, customers=customers, moves=moves)) == expected


def test_a_version_that_both_roles_want_is_one_row(spark):
    documents = spark.createDataFrame(
        [document(1), document(2, changed="2024-01-10"), document(2, changed="2024-01-12"),
         document(2, changed="2024-01-20")], schemas.DOCUMENT)
    heads = orders.current_documents(documents).select("DocumentId", "oldest", "newest")
    assert rows(heads) == [(1, True, True), (2, False, True), (2, True, False)]
