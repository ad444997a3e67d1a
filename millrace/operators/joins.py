"""Joins (J1, J6, J7, J10). The strategy is Spark's; hints only behind a size check."""

from __future__ import annotations

from itertools import count
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.operators.axis import POS
from millrace.operators.scale import numbered
from millrace.operators.series import running
from millrace.session import cut_lineage

UNKNOWN_COUNTRY = "XXX"


def enrich_orders(tables: Mapping[str, DataFrame], status_id: int) -> DataFrame:
    """J1: every order line of one status with its product, category, brand, stock, buyer.

    Expects the shop tables products, categories, brands, inventory, order_detail, orders, users,
    order_status. The status filter reaches the orders scan before any join.
    """
    t = tables
    orders = t["orders"].where(F.col("status_id") == F.lit(status_id))
    lines = t["order_detail"].select("order_id", "product_id", "quantity", "item_price")
    products = (
        t["products"].select(F.col("id").alias("product_id"), "product_name", "price", "category_id", "brand_id")
        .join(t["categories"].select(F.col("id").alias("category_id"), "category_name"), "category_id")
        .join(t["brands"].select(F.col("id").alias("brand_id"), "brand_name"), "brand_id")
        .join(t["inventory"].select("product_id", F.col("quantity").alias("stock")), "product_id")
    )
    status = t["order_status"].select(F.col("id").alias("status_id"), F.trim("status_name").alias("status_name"))
    users = t["users"].select(F.col("id").alias("user_id"), "username", "fullname", "address")
    heads = orders.select(F.col("id").alias("order_id"), "user_id", "status_id", "payment", "created_at")
    return lines.join(heads, "order_id").join(products, "product_id").join(users, "user_id").join(status, "status_id")


def lookup_country(df: DataFrame, code: str, dimension: DataFrame, kind: str = "cca2") -> DataFrame:
    """J6: adds ``country, cca3, lat, lng``; an unknown code gets ``XXX``.

    ``dimension`` has cca2, cca3, cioc, name, lat, lng.
    """
    if kind not in dimension.columns:
        raise QueryError(f"unknown country code kind: {kind}")
    small = dimension.select(
        F.upper(F.col(kind).cast("string")).alias("__code"),
        F.col("name").alias("country"),
        F.col("cca3").alias("__cca3"),
        "lat",
        "lng",
    )
    joined = df.join(small, F.upper(F.col(code).cast("string")) == F.col("__code"), "left")
    return joined.withColumn("cca3", F.coalesce("__cca3", F.lit(UNKNOWN_COUNTRY))).drop("__code", "__cca3")


def dedup_names(names: Sequence[str]) -> list[str]:
    """Each name once: a repeated one gets the first free of ``__1``, ``__2`` … (``foo, bar, bar__1``)."""
    given, out = set(names), []
    for name in names:
        numbered = (f"{name}__{i}" for i in count(1))
        out.append(name if name not in out else next(n for n in numbered if n not in given and n not in out))
    return out


def double_lookup(df: DataFrame, dimension: DataFrame, key: str, a_col: str, b_col: str) -> DataFrame:
    """J7: the same dimension joined for two columns; clashing names get a suffix."""
    details = [c for c in dimension.columns if c != key]
    names = dedup_names([*df.columns, *details, *details])
    a_names, b_names = names[len(df.columns) : len(df.columns) + len(details)], names[-len(details) :]
    first = dimension.select(F.col(key).alias("__a"), *[F.col(c).alias(n) for c, n in zip(details, a_names)])
    second = dimension.select(F.col(key).alias("__b"), *[F.col(c).alias(n) for c, n in zip(details, b_names)])
    joined = df.join(first, F.col(a_col) == F.col("__a"), "left")
    joined = joined.join(second, F.col(b_col) == F.col("__b"), "left")
    return joined.drop("__a", "__b")


def ip_number(text: Column) -> Column:
    """Dotted IPv4 text to its number; anything else is null."""
    octets = [F.regexp_extract(text, r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$", i).try_cast("bigint") for i in range(1, 5)]
    return octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]


def networks(df: DataFrame, cidr: str) -> DataFrame:
    """CIDR text to ``first``, ``last`` and ``prefix`` (bits), by expressions."""
    parts = F.split(F.col(cidr), "/")
    bits = F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("int"), F.lit(32))
    size = F.pow(F.lit(2.0), 32 - bits).cast("bigint")
    address = ip_number(F.element_at(parts, 1))
    first = address - F.pmod(address, size)
    return df.withColumns({"first": first, "last": first + size - 1, "prefix": bits})


#: Networks that go to every task whole; more are swept.
FEW_NETWORKS = 50_000


def _covering(points: DataFrame, at: str, ranges: DataFrame, lengths: list[int]) -> DataFrame:
    """Pairs of points and the networks that hold them: one probe for each prefix length in use."""
    width = {p: 2 ** (32 - p) for p in lengths}
    keys = F.array(*[F.struct(F.lit(p).alias("bits"), (F.col(at) - F.pmod(F.col(at), F.lit(width[p]))).alias("start")) for p in lengths])
    probes = points.withColumn("__probe", F.explode(keys))
    same = (F.col("__probe.bits") == F.col("prefix")) & (F.col("__probe.start") == F.col("first"))
    return probes.join(ranges, same, "inner").drop("__probe")


def _swept(df: DataFrame, ip: str, ranges: DataFrame, lengths: list[int]) -> DataFrame:
    """One sweep over boundaries and addresses in ascending order.

    At each address where a network begins or has just ended stands the list of networks that hold it; networks are
    nested or apart, so that is at most one of each length (a network given n times counts n times). Each address takes
    the list that stands before it, in its piece of the order or handed on from the pieces before it as one row each.
    No network is a key, however many addresses it holds.
    """
    nets = cut_lineage(ranges)
    starts = nets.select(F.explode(F.array(F.col("first"), F.col("last") + 1)).alias("__at")).distinct()
    open_there = _covering(starts, "__at", nets, lengths).groupBy("__at").agg(F.collect_list(F.struct(*nets.columns)).alias("__open"))
    bounds = starts.join(open_there, "__at", "left").select("__at", F.struct(F.col("__open").alias("nets")).alias("__open"))
    rows = df.select(F.col(ip).cast("bigint").alias("__at"), F.struct(*df.columns).alias("__given"))
    both = bounds.unionByName(rows, allowMissingColumns=True)
    placed = numbered(both, [F.asc_nulls_first("__at"), F.col("__given").isNotNull()], POS)
    held = running(placed, [], {"__nets": ("last", "__open")}).where(F.col("__given").isNotNull())
    return held.select("__given.*", F.explode("__nets.nets").alias("__net")).select(*df.columns, "__net.*")


def ip_range_join(df: DataFrame, ip: str, ranges: DataFrame, how: str = "inner", few: int = FEW_NETWORKS) -> DataFrame:
    """J10: which networks hold each address (number). ``ranges`` has first, last, prefix.

    Up to ``few`` networks go to every task, where an address looks up one network of each prefix length in
    use (at most 33); more are swept with the addresses in ascending order.
    """
    if how not in ("inner", "left"):
        raise QueryError("ip_range_join is inner or left")
    found = ranges.agg(F.sort_array(F.collect_set("prefix")).alias("lengths"), F.count(F.lit(1)).alias("n")).first()
    if not found["lengths"]:
        raise QueryError("no networks given")
    if found["n"] <= few:
        matched = _covering(df, ip, F.broadcast(ranges), found["lengths"])
    else:
        matched = _swept(df, ip, ranges, found["lengths"])
    if how == "inner":
        return matched
    missing = df.join(matched.select(ip).distinct(), ip, "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)
