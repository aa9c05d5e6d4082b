"""From ledger lines, documents and exchange rates to net order values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.money import in_base_currency, net_amount, net_of_return
from clientele.operators.joins import semi_join
from clientele.operators.versions import ORDER, RETURN, version_bounds, version_second
from clientele.session import written

# Up to this share of all customers, a daily set finds their part of the ledger first.
FEW = 0.05


def counted_item(item: str = "ItemId") -> Column:
    """Items whose id starts with a capital P do not count; a NULL item id drops out too."""
    return ~F.col(item).like("P%")


def signed_lines(lines: DataFrame) -> DataFrame:
    """Countable lines with their role: positive amounts are orders, negative ones returns."""
    amount = F.col("AmountWithoutVat")
    role = F.when(amount > 0, ORDER).when(amount < 0, RETURN)
    return (lines.where(counted_item() & (amount != 0))
            .select("Id", "DocumentId", "SalesOrderId", role.alias("role"),
                    net_amount(amount, F.col("DiscountAmountWithoutVat")).alias("net"),
                    version_second().alias("second")))


def document_heads(documents: DataFrame) -> DataFrame:
    """What an order or a return takes from its document, a row for each version."""
    return documents.select(F.col("Id").alias("DocumentId"), "OrderId", F.col("BillToEmail").alias("userId"),
                            "CurrencyCode", F.to_date("CreatedOn").alias("day"), version_second().alias("second"))


def current_documents(documents: DataFrame) -> DataFrame:
    """Documents in the versions that a role wants: the first (``oldest``) for orders, the last (``newest``) for returns.

    A version that both want is one row.
    """
    bounds = version_bounds(documents, "OrderId")
    oldest, newest = F.col("second") == F.col("_first"), F.col("second") == F.col("_last")
    return (document_heads(documents)
            .join(bounds, (F.col("OrderId") == F.col("_key")) & (oldest | newest))
            .select("DocumentId", "OrderId", "userId", "CurrencyCode", "day",
                    oldest.alias("oldest"), newest.alias("newest")))


def movements(lines: DataFrame, documents: DataFrame,
              customers: DataFrame | None = None) -> DataFrame:
    """Exact amounts in local currency, a row per document order, role, order, day and currency.

    Orders and returns share every scan and shuffle: a line has one role by its
    sign, and takes the versions that its role wants.  ``customers`` (a distinct
    ``userId`` column, written) keeps only what can matter to those customers' orders;
    it is found by a few small jobs at once, before the lines are shuffled.

    All versions of the documents meet their lines by document id, once; the lines' sums, which are
    fewer, then go to the versions that their role wants, by order id.  That is where an order's amounts
    stay: only returns move on, to the orders they name (``local_returns``).
    """
    if customers is None:
        heads, candidates = document_heads(documents), signed_lines(lines)
        bounds = version_bounds(lines, "Id")
    else:
        heads, candidates, versioned = _of_customers(lines, documents, customers)
        bounds = written(version_bounds(versioned, "Id"), "line-versions")
    is_order = F.col("role") == ORDER
    wanted = F.col("second") == F.when(is_order, F.col("_first")).otherwise(F.col("_last"))
    chosen = (candidates.join(bounds, (F.col("Id") == F.col("_key")) & wanted)
              .select("DocumentId", "SalesOrderId", "role", "net"))
    met = chosen["DocumentId"] == heads["DocumentId"]
    versions = ["second"] if customers is None else []
    if customers is not None:
        met &= F.when(is_order, F.col("oldest")).otherwise(F.col("newest"))
    keys = ["OrderId", "role", "order_key", "userId", "day", "CurrencyCode"]
    sums = (chosen.join(heads, met)
            .select(heads["DocumentId"], *versions, "OrderId", "role",
                    F.when(is_order, F.col("OrderId")).otherwise(F.col("SalesOrderId")).alias("order_key"),
                    F.when(is_order, F.col("userId")).alias("userId"), "day", "CurrencyCode", "net")
            .groupBy("DocumentId", *versions, *keys).agg(F.sum("net").alias("net")))
    if customers is None:
        sums = sums.join(version_bounds(documents, "OrderId"), (F.col("OrderId") == F.col("_key")) & wanted)
    return (sums.groupBy(*keys)
            # ``kind`` repeats the role as an aggregate.  A filter on it stays above the
            # aggregate, so the order and the return branch have the same plan below and
            # Spark runs its shuffles once; a filter on ``role`` would be pushed down
            # and split the plan in two.  So would a later filter or semi join on the orders'
            # ``userId``, which local_orders ties to ``kind``; ``kind == ORDER`` would untie it,
            # because Spark puts such constants into the other conditions.
            .agg(F.sum("net").alias("net"), F.max("role").alias("kind")))


def _of_customers(lines: DataFrame, documents: DataFrame,
                  customers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Document heads, candidate lines and line versions that matter to some customers' orders.

    Each narrowing is a small table written once, so that the next step scans the ledger for
    its keys alone: the lines twice (candidates, versions of their ids), the documents four times.
    All versions of a key that is kept are kept, so the versions chosen are the same.
    """
    named = written(documents.select("OrderId", F.col("BillToEmail").alias("userId"))
                    .join(customers, "userId", "left_semi")
                    .where(F.col("OrderId").isNotNull()).select("OrderId").distinct(), "named-orders")
    heads = written(current_documents(documents.join(named, "OrderId", "left_semi")), "order-heads")
    theirs = heads.where("oldest").join(customers, "userId", "left_semi")
    # Lines on the orders' documents, and return lines against those orders.
    links = F.array(
        F.struct(F.lit(ORDER).alias("role"), F.col("DocumentId").alias("link")),
        F.struct(F.lit(RETURN).alias("role"), F.col("OrderId").alias("link")))
    keys = written(theirs.select(F.inline(links)).distinct(), "line-links")
    link = F.when(F.col("role") == ORDER, F.col("DocumentId")).otherwise(F.col("SalesOrderId"))
    candidates = written(signed_lines(lines).withColumn("link", link)
                         .join(keys, ["role", "link"], "left_semi").drop("link"), "candidate-lines")
    ids = written(candidates.select("Id").distinct(), "candidate-ids")
    versioned = lines.select("Id", "__ts_ms").join(ids, "Id", "left_semi")
    # The documents of the returns name other orders than the ones returned.
    credit = written(candidates.where(F.col("role") == RETURN).select(F.col("DocumentId").alias("Id"))
                     .distinct(), "credit-ids")
    credited = written(documents.join(credit, "Id", "left_semi").where(F.col("OrderId").isNotNull())
                       .select("OrderId").distinct(), "credit-orders")
    credits = current_documents(documents.join(credited, "OrderId", "left_semi"))
    heads = (heads.where("oldest").withColumn("newest", F.lit(False))
             .unionByName(credits.where("newest").withColumn("oldest", F.lit(False))))
    return heads, candidates, versioned


def _amount(net: Column) -> Column:
    return F.round(net, 2).cast("double")


def local_orders(moves: DataFrame) -> DataFrame:
    """One row per order, customer, day and currency; an order's document names it, so its sums are whole."""
    is_order = F.col("kind") > RETURN
    return (moves.where(is_order)
            .select(F.col("OrderId"), F.col("day").alias("order_date"),
                    F.when(is_order, F.col("userId")).alias("userId"), "CurrencyCode",
                    _amount(F.col("net")).alias("order_revenue")))


def local_returns(moves: DataFrame) -> DataFrame:
    """One row per order, day and currency: returns of several credit documents are summed."""
    return (moves.where(F.col("kind") < ORDER)
            .groupBy("order_key", "role", "day", "CurrencyCode").agg(F.sum("net").alias("net"))
            .select(F.col("order_key").alias("SalesOrderId"), F.col("day").alias("return_date"),
                    "CurrencyCode", _amount(F.col("net")).alias("return_amount")))


def convert(df: DataFrame, rates: DataFrame, amount: str, day: str) -> DataFrame:
    """Replace a local amount by its value in base currency; no rate gives NULL.

    The rate table is left unhinted: Spark broadcasts it when it is small enough
    by its own statistics or at run time, and otherwise joins by shuffle, where
    AQE splits a crowded (currency, day).
    """
    daily = rates.select("CurrencyCode", F.col("Date").alias("_day"), F.col("Rate").alias("_rate"))
    return (df.join(daily, (df["CurrencyCode"] == daily["CurrencyCode"])
                    & (F.col(day) == F.col("_day")), "left")
            .select(*[df[c] for c in df.columns if c not in (amount, "CurrencyCode")],
                    in_base_currency(F.col(amount), F.col("_rate")).alias(amount)))


def net_orders(orders: DataFrame, returns: DataFrame, mode: str = "per_date") -> DataFrame:
    """Orders joined with their returns.

    ``per_date`` keeps one row per (order, return day), each net of that day's
    return; ``total`` nets all returns of an order in one row.
    """
    if mode == "total":
        # A NULL return counts as no return, also inside the total.
        exact = F.sum(F.col("return_amount").cast("decimal(28,2)")).cast("double")
        returns = returns.groupBy("SalesOrderId").agg(exact.alias("return_amount"))
    elif mode != "per_date":
        raise ValueError(f"returns must be per_date or total, not {mode!r}")
    returned = returns.select("SalesOrderId", "return_amount")
    return (orders.join(returned, F.col("OrderId") == F.col("SalesOrderId"), "left")
            .select("OrderId", "userId", "order_date",
                    net_of_return(F.col("order_revenue"), F.col("return_amount"))
                    .alias("order_value")))


def few(customers: DataFrame, documents: DataFrame) -> bool:
    """Whether these are so few of the documents' customers that their part of the ledger is found first.

    Only the plan depends on it, so an approximate count of the customers is enough.
    """
    known = documents.agg(F.approx_count_distinct("BillToEmail")).first()[0]
    return customers.count() <= FEW * known


def order_values(lines: DataFrame, documents: DataFrame, rates: DataFrame,
                 returns: str = "per_date", customers: DataFrame | None = None,
                 moves: DataFrame | None = None) -> DataFrame:
    """Net value of every order in base currency: (OrderId, userId, order_date, order_value).

    With ``customers`` only their orders: few customers' part of the ledger is found first, by key lists that
    are small; the lists of many would shuffle lines and documents more often than the amounts of all orders
    do, which are then taken as a table.  ``moves`` is that table (``movements`` of all customers), where another
    step on the same ledger has written it.
    """
    narrow, given = None, moves is not None
    if customers is not None:
        customers = written(customers, "customers")
        narrow = customers if not given and few(customers, documents) else None
    # A return without an order never matches.  Said here for both branches, because
    # Spark would infer it for the return branch alone and so split the shared plan.
    moves = (moves if given else movements(lines, documents, narrow)).where(F.col("order_key").isNotNull())
    if customers is not None and narrow is None and not given:
        moves = written(moves, "movements")
    orders = local_orders(moves)
    if customers is not None:
        orders = semi_join(orders, customers, ["userId"])
    return net_orders(convert(orders, rates, "order_revenue", "order_date"),
                      convert(local_returns(moves), rates, "return_amount", "return_date"),
                      returns)
