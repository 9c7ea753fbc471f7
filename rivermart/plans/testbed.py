"""The pipeline's inputs, derived from the star-schema tables.

Some rows are left out of the dimensions and some texts are broken on purpose,
chosen by an attribute, so that failed lookups and invalid records occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rivermart import schemas
from rivermart.functions import cents, from_cents
from rivermart.operators.lookup import lookup
from rivermart.operators.orders import with_order_columns
from rivermart.operators.skew import estimated_bytes
from rivermart.sources.storage import work_folder
from rivermart.sources.tables import read_table

LEFT_OUT_REGION = "MIDDLE EAST"
LEFT_OUT_SEGMENT = "MACHINERY"
LEFT_OUT_BRAND = "Brand#7"
LEFT_OUT_SIZE = 13
LEFT_OUT_CATEGORY2 = 5
LEFT_OUT_SPU_TYPE = "PROMO"
LEFT_OUT_SKU_TYPE = "ECONOMY"
FIRST_BATCH_UNTIL = "1998-04-01"
FIRST_BATCH_LINES = 3
LINES_PER_ORDER = 1000
SPLIT_BYTES = 16 << 20


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _seconds(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), count)


def as_json(rows: DataFrame, *keep: str) -> DataFrame:
    """Each row as JSON text in ``value``; ``keep`` columns stay outside."""
    fields = [name for name in rows.columns if name not in keep]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"), *keep)


class Testbed:
    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def _spread_table(self, name: str) -> DataFrame:
        """A table whose rows are turned to JSON, which is work for all cores: if its
        files are too small to be split among them, the rows are dealt out."""
        rows = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        size = estimated_bytes(rows)
        return rows.repartition(cores) if size is not None and size < cores * SPLIT_BYTES else rows

    # ------------------------------------------------------------ dimensions

    def provinces(self) -> DataFrame:
        return self.table("nation").select(
            _text("n_nationkey").alias("id"), F.concat(F.lit("CN-"), "n_nationkey").alias("iso_code"),
            F.col("n_name").alias("name"), F.concat(F.lit("10"), "n_nationkey").alias("area_code"),
            _text("n_regionkey").alias("region_id"))

    def regions(self) -> DataFrame:
        return (self.table("region").filter(F.col("r_name") != LEFT_OUT_REGION)
                .select(_text("r_regionkey").alias("id"), F.col("r_name").alias("region_name")))

    def all_users(self) -> DataFrame:
        key = F.col("c_custkey")
        birthday = F.date_add(F.lit("1940-01-01").cast("date"),
                              F.pmod(key * 37, F.lit(29000)).cast("int"))
        none = F.lit(None).cast("string")
        return self.table("customer").select(
            _text(key).alias("id"), F.lower("c_name").alias("login_name"),
            F.col("c_name").alias("nick_name"), none.alias("passwd"), F.col("c_name").alias("name"),
            F.concat(F.lit("139"), key).alias("phone_num"),
            F.concat(F.lit("user"), key, F.lit("@example.com")).alias("email"),
            none.alias("head_img"), F.col("c_mktsegment").alias("user_level"),
            _text(birthday).alias("birthday"),
            F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
            F.lit("2019-01-01 00:00:00").alias("create_time"), none.alias("operate_time"))

    def users(self) -> DataFrame:
        return self.all_users().filter(F.col("user_level") != LEFT_OUT_SEGMENT)

    def _trademark(self) -> Column:
        return F.regexp_extract("p_brand", r"(\d+)", 1)

    @staticmethod
    def spu_id() -> Column:
        return F.call_function("div", F.col("p_partkey"), F.lit(4).cast("bigint"))

    def skus(self) -> DataFrame:
        """SKU rows before flattening."""
        return self.table("part").select(
            _text("p_partkey").alias("id"), _text(self.spu_id()).alias("spu_id"),
            F.col("p_retailprice").alias("price"), F.col("p_name").alias("sku_name"),
            F.concat_ws(" ", "p_type", "p_name").alias("sku_desc"),
            (F.col("p_size") / F.lit(10.0)).alias("weight"), self._trademark().alias("tm_id"),
            _text("p_size").alias("category3_id"), F.lit("2021-07-03 08:05:00").alias("create_time"))

    def trademarks(self) -> DataFrame:
        return (self.table("part").filter(F.col("p_brand") != LEFT_OUT_BRAND)
                .select(self._trademark().alias("tm_id"), F.col("p_brand").alias("tm_name")).distinct())

    def categories(self, level: int) -> DataFrame:
        size = F.col("p_size")
        low, middle, top = size, size % 10, (size % 10) % 3
        if level == 3:
            rows = self.table("part").filter(size != LEFT_OUT_SIZE).select(
                _text(low).alias("id"), _text(middle).alias("category2_id"))
        elif level == 2:
            rows = self.table("part").filter(middle != LEFT_OUT_CATEGORY2).select(
                _text(middle).alias("id"), _text(top).alias("category1_id"))
        else:
            rows = self.table("part").select(_text(top).alias("id"))
        return rows.distinct().withColumn(
            "name", F.concat(F.lit(f"category{level} "), "id"))

    def spus(self) -> DataFrame:
        return (self.table("part").filter(F.col("p_type") != LEFT_OUT_SPU_TYPE)
                .select(_text(self.spu_id()).alias("id"))
                .distinct().withColumn("spu_name", F.concat(F.lit("spu_"), "id")))

    def flat_skus(self, complete: bool = True) -> DataFrame:
        """Flattened SKUs; the incomplete form lacks one type of part."""
        part = self.table("part")
        if not complete:
            part = part.filter(F.col("p_type") != LEFT_OUT_SKU_TYPE)
        return part.select(
            _text("p_partkey").alias("id"), _text(self.spu_id()).alias("spu_id"),
            F.col("p_retailprice").alias("price"), F.col("p_name").alias("sku_name"),
            self._trademark().alias("tm_id"), F.col("p_brand").alias("tm_name"),
            _text("p_size").alias("category3_id"),
            F.concat(F.lit("category3 "), "p_size").alias("category3_name"),
            F.concat(F.lit("spu_"), self.spu_id()).alias("spu_name"))

    # ------------------------------------------------- change feeds of the dims

    def category_feed(self, level: int) -> DataFrame:
        """One change record per part; later parts rename their category."""
        size, at = F.col("p_size"), F.col("p_partkey")
        name = F.concat(F.lit(f"category{level} at "), at).alias("name")
        low, middle, top = size, size % 10, (size % 10) % 3
        fields = {1: [top.alias("id"), name],
                  2: [middle.alias("id"), name, _text(top).alias("category1_id")],
                  3: [low.alias("id"), name, middle.alias("category2_id")]}[level]
        return as_json(self.table("part").select(*fields, at.alias("offset")), "offset")

    def spu_feed(self) -> DataFrame:
        return as_json(self.table("part").select(
            self.spu_id().alias("id"), F.concat(F.lit("spu_"), self.spu_id()).alias("spu_name"),
            F.col("p_name").alias("description"), F.col("p_size").alias("category3_id"),
            self._trademark().alias("tm_id"), F.col("p_partkey").alias("offset")), "offset")

    def level_changes(self) -> DataFrame:
        """Every order sets its user's level."""
        return self.table("orders").select(
            _text("o_custkey").alias("id"), F.col("o_orderpriority").alias("user_level"),
            _text("o_orderdate").alias("changed"), F.col("o_orderkey").alias("offset"))

    # ---------------------------------------------------------------- facts

    def _create_time(self) -> Column:
        return F.col("o_orderdate") + _seconds(F.pmod("o_orderkey", F.lit(86400)))

    def orders(self, totals: bool = True) -> DataFrame:
        """order_info rows as the source sends them."""
        orders = self.table("orders")
        if totals:
            lines = lookup(self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity"),
                           self.table("part"), "l_partkey", "p_partkey", {"_price": "p_retailprice"})
            sums = lines.groupBy("l_orderkey").agg(
                F.sum(F.col("l_quantity").cast("bigint") * cents(F.col("_price"))).alias("_cents"))
            orders = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            original = F.coalesce("_cents", F.lit(0))
        else:
            original = F.lit(0)
        final = cents(F.col("o_totalprice"))
        zero = F.lit(0).cast("bigint")
        return orders.select(
            F.col("o_orderkey").alias("id"), F.pmod("o_orderkey", F.lit(27)).alias("province_id"),
            F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("final_total_amount"),
            from_cents(F.greatest(original - final, zero)).alias("benefit_reduce_amount"),
            from_cents(original).alias("original_total_amount"),
            from_cents(F.greatest(final - original, zero)).alias("feight_fee"),
            _text(self._create_time() + _seconds(F.lit(900))).alias("expire_time"),
            _text(self._create_time()).alias("create_time"),
            F.when(F.col("o_orderstatus") != "O", _text(self._create_time() + _seconds(F.lit(60))))
            .alias("operate_time"))

    def order_info(self, totals: bool = True) -> DataFrame:
        return with_order_columns(self.orders(totals))

    def order_times(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("id"),
                                           _text(self._create_time()).alias("create_time"))

    def details(self, *extra: Column, spread: bool = False) -> DataFrame:
        """order_detail rows as the source sends them; ids number each order's lines.

        The shuffle by order is the one that joins and splits by order use again.
        """
        lines = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
        number = F.row_number().over(lines).cast("bigint")
        identity = F.when(number < LINES_PER_ORDER, F.col("l_orderkey") * LINES_PER_ORDER + number).otherwise(
            F.raise_error(F.lit(f"an order has {LINES_PER_ORDER} lines or more")).cast("bigint"))
        return (self._spread_table if spread else self.table)("lineitem").select(
            identity.alias("id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.concat(F.lit("sku "), "l_partkey").alias("sku_name"), *extra)

    def order_detail(self, *extra: str) -> DataFrame:
        """Typed details without SKU attributes."""
        rows = self.details(*(F.col(name) for name in extra))
        defaults = {"bigint": F.lit(0).cast("bigint"), "double": F.lit(0.0),
                    "string": F.lit(None).cast("string")}
        return rows.select(*(F.col(name) if name in rows.columns else defaults[kind].alias(name)
                             for name, kind in schemas.ORDER_DETAIL.items()), *extra)

    def priced_detail(self, *extra: str) -> DataFrame:
        return lookup(self.order_detail(*extra).drop("sku_price"), self.flat_skus(), "sku_id", "id",
                      {"sku_price": "price"})

    @staticmethod
    def at(rows: DataFrame, order_key: str, name: str, line: str | None = None) -> DataFrame:
        """Arrival time: a second per order key, two more per line number."""
        late = F.col(order_key) if line is None else F.col(order_key) + 2 * F.col(line)
        return rows.withColumn(name, F.lit("2024-01-01").cast("timestamp") + _seconds(late))

    # ------------------------------------------------------- records and logs

    def order_records(self) -> DataFrame:
        return as_json(self.orders())

    def detail_records(self) -> DataFrame:
        """Raw details; the number is sent as text, the price under another name."""
        return as_json(self.details(spread=True).withColumns({
            "sku_num": _text("sku_num"), "order_price": F.lit(19.5),
            "img_url": F.lit("https://pictures.example.org/a.png"), "source_type": F.lit("web")}))

    def maxwell(self) -> DataFrame:
        """Change envelopes of three tables."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        kind = (F.when(priority == "1-URGENT", "insert").when(priority == "2-HIGH", "update")
                .when(priority == "3-MEDIUM", "bootstrap-insert")
                .when((priority == "4-NOT SPECIFIED") & (status == "F"), "bootstrap-start")
                .when((priority == "4-NOT SPECIFIED") & (status == "O"), "bootstrap-complete")
                .when((priority == "4-NOT SPECIFIED") & (status == "P"), "delete")
                .when((priority == "5-LOW") & (status != "F"), "insert"))
        orders = self._envelope(
            self._spread_table("orders"), "order_info", kind, F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("final_total_amount"))
        users = self._envelope(self.table("customer"), "user_info", F.lit("insert"),
                               F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
        skus = self._envelope(self.table("part"), "sku_info", F.lit("update"),
                              F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
        return orders.unionByName(users).unionByName(skus)

    @staticmethod
    def _envelope(rows: DataFrame, table: str, kind: Column, *data: Column) -> DataFrame:
        return rows.select(F.to_json(F.struct(
            F.lit("shop").alias("database"), F.lit(table).alias("table"), kind.alias("type"),
            F.lit(1700000100).alias("ts"), F.lit(501).alias("xid"), F.lit(True).alias("commit"),
            F.struct(*data).alias("data"))).alias("value"))

    def canal(self) -> DataFrame:
        """One envelope per line: returned lines carry a reversal too, and lines neither
        returned nor open stand for schema changes without data."""
        rows = self.details(F.col("l_returnflag"), F.col("l_linestatus"), spread=True)

        def element(sign: int) -> Column:
            return F.struct(_text(F.col("id") * sign).alias("id"), _text("order_id").alias("order_id"),
                            _text("sku_id").alias("sku_id"),
                            _text(F.col("sku_num") * sign).alias("sku_num"))

        schema_change = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
        data = (F.when(schema_change, F.lit(None))
                .when(F.col("l_returnflag") == "R", F.array(element(1), element(-1)))
                .otherwise(F.array(element(1))))
        return rows.select(F.to_json(F.struct(
            data.alias("data"), F.lit("shop").alias("database"), schema_change.alias("isDdl"),
            F.lit("order_detail").alias("table"), F.lit(1700000200300).alias("ts"),
            F.lit("INSERT").alias("type"))).alias("value"))

    def logs(self) -> DataFrame:
        """App start logs as (event_id, value); see ``log_state`` for the broken ones."""
        millis = _text(F.unix_millis(F.col("ts").cast("timestamp")))
        kind, value = F.col("event_type"), F.col("value")
        no_mid = (kind == "signup") & (value < 20)
        no_ts = (kind == "purchase") & (value < 10)
        no_uid = (kind == "view") & (value < 30)
        text = F.to_json(F.struct(
            F.when(~no_mid, F.concat(F.lit("mid_"), "user_id")).alias("mid"),
            F.when(~no_uid, F.concat(F.lit("uid_"), "user_id")).alias("uid"),
            kind.alias("ar"), F.when(kind != "purchase", F.lit("web")).alias("ch"),
            F.lit("4.2.0").alias("vc"), F.when(~no_ts, millis).alias("ts")))
        click = kind == "click"
        broken = (F.when((kind == "error") & (value >= 20), F.left(text, F.length(text) - 5))
                  .when(click & (value < 5), F.lit("[1]")).when(click & (value < 10), F.lit(""))
                  .when(click & (value < 12), F.lit("null"))
                  .when(click & (value < 14), F.replace(text, F.lit('"uid":"'), F.lit('"uid":null,"x":"')))
                  .otherwise(text))
        return self.table("events").select("event_id", broken.alias("value"))


class StagedTestbed(Testbed):
    """Derived inputs are written when first asked for and then read from files, so that a
    second run of a query does the operator's work only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._staged: dict[str, DataFrame] = {}

    def _stage(self, key: str, rows: DataFrame) -> DataFrame:
        folder = work_folder(self.spark, "staged")
        rows.write.parquet(folder)
        self._staged[key] = self.spark.read.schema(rows.schema).parquet(folder)
        return self._staged[key]


def _staged(name: str):
    make = getattr(Testbed, name)

    def method(self: StagedTestbed, *args, **options) -> DataFrame:
        key = f"{name} {args} {options}"
        return self._staged[key] if key in self._staged else self._stage(key, make(self, *args, **options))
    return method


for _name in ("all_users", "users", "skus", "trademarks", "categories", "spus", "flat_skus", "category_feed",
              "spu_feed", "level_changes", "orders", "order_info", "order_times", "details", "order_detail",
              "priced_detail", "order_records", "detail_records", "maxwell", "canal", "logs"):
    setattr(StagedTestbed, _name, _staged(_name))
