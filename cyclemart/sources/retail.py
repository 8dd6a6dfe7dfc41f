"""ERP-shaped views over the retail star schema (orders, lineitem, customer, part, ...).

Ids are shifted by one so that no real id is 0, which stands for "all" or "goals". The seller and
the return flag sit on the item here, the company comes from the customer's region.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.config import SalesRules
from cyclemart.sources import documents as D
from cyclemart.sources.tables import read_parquet

RETAIL_RULES = SalesRules(
    holidays=(date(1997, 12, 25), date(1998, 1, 1), date(1998, 2, 24)),
    rate_floor=date(1998, 1, 1),
)

Period = tuple[date, date] | None

#: Files of the item table below the source folder.
ITEM_FILES = "lineitem*.parquet"


class RetailSource:
    def __init__(self, spark: SparkSession, path: str, rules: SalesRules = RETAIL_RULES, files: dict[str, str] | None = None,
                 span: tuple[date, date] | None = None):
        """``files`` names tables that lie elsewhere than below ``path``. ``span`` says which days the cycles must cover;
        without it they cover all days of the tables."""
        self.spark, self.path, self.rules, self.files, self._span = spark, path, rules, files or {}, span

    def spanning(self, first: date, last: date) -> RetailSource:
        """The same source with the cycles of some days, which are not looked for in the tables."""
        return RetailSource(self.spark, self.path, self.rules, self.files, (first, last))

    def table(self, name: str, *columns: str) -> DataFrame:
        """Columns of a source table. Items come in any number of files, the same that the refresh streams."""
        file = ITEM_FILES if name == "lineitem" else f"{name}.parquet"
        return read_parquet(self.spark, self.files.get(name, f"{self.path}/{file}"), *columns)

    # documents -----------------------------------------------------------------------------

    def _orders(self, condition: Column | None = None) -> DataFrame:
        orders = self.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        if condition is not None:
            orders = orders.filter(condition)
        return orders.select(
            F.col("o_orderkey").alias("nunota"), F.to_date("o_orderdate").alias("data_pedido"), "o_custkey",
            F.col("o_orderstatus").alias("situacao"),
        )

    def with_company(self, documents: DataFrame) -> DataFrame:
        """Documents, or their lines, with the company and customer in place of the customer key."""
        company = self.table("customer", "c_custkey", "c_nationkey").join(
            self.table("nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return documents.join(company, F.col("o_custkey") == F.col("c_custkey")).select(
            *[c for c in documents.columns if c != "o_custkey"],
            (F.col("n_regionkey") + 1).cast("bigint").alias("codemp"),
            (F.col("o_custkey") + 1).alias("codparc"),
        )

    def _headers(self, condition: Column | None = None) -> DataFrame:
        """Orders with their company. The customer side joins before the items do, so the large
        item join is the last shuffle and leaves the lines partitioned by document."""
        return self.with_company(self._orders(condition))

    def _items(self, condition: Column | None = None, cost: bool = False) -> DataFrame:
        items = self.table(
            "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_returnflag", "l_shipdate",
        )
        if condition is not None:
            items = items.filter(condition)
        columns = [
            F.col("l_orderkey").alias("nunota"),
            (F.col("l_suppkey") + 1).alias("codvend"),
            (F.col("l_partkey") + 1).alias("codprod"),
            F.col("l_quantity").cast("decimal(15,2)").alias("qtdneg"),
            F.col("l_extendedprice").cast("decimal(15,2)").alias("vlrtot"),
            (F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_discount").cast("decimal(4,2)")).alias("vlrdesc"),
            F.col("l_returnflag").alias("devolvido"),
            F.to_date("l_shipdate").alias("data_envio"),
        ]
        if cost:
            items = items.join(self.table("part", "p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
            columns.append(F.col("p_retailprice").cast("decimal(15,2)").alias("vlrcus"))
        return items.select(*columns)

    @staticmethod
    def _between(column: str, period: Period) -> Column | None:
        """Range on the raw timestamp, so that it reaches the parquet row groups."""
        if period is None:
            return None
        c = F.col(column)
        return (c >= F.lit(period[0]).cast("timestamp_ntz")) & (
            c < F.date_add(F.lit(period[1]), 1).cast("timestamp_ntz")
        )

    @staticmethod
    def _and(*conditions: Column | None) -> Column | None:
        present = [c for c in conditions if c is not None]
        out = present[0] if present else None
        for c in present[1:]:
            out = out & c
        return out

    def sales(self, period: Period = None, cost: bool = False) -> DataFrame:
        headers = self._headers(self._and(F.col("o_orderstatus") != "P", self._between("o_orderdate", period)))
        lines = D.document_lines(headers, self._items(F.col("l_returnflag") != "R", cost))
        lines = lines.withColumns({
            "data_ref": F.col("data_pedido"), "codtipoper": F.lit(3107), "statusnfe": F.lit("A"),
        })
        return D.approved_sales(lines, self.rules)

    def returns(self, period: Period = None) -> DataFrame:
        items = self._items(self._and(F.col("l_returnflag") == "R", self._between("l_shipdate", period)))
        kept = F.col("o_orderstatus") != "P"
        if period is None:
            lines = D.document_lines(self._headers(kept), items)
        else:
            # A period is on the item: its few lines pick the documents, whose customers are looked up last.
            lines = self.with_company(D.document_lines(self._orders(kept), items))
        lines = lines.withColumns({
            "data_ref": F.col("data_envio"), "codtipoper": F.lit(2200), "statusnfe": F.lit(None).cast("string"),
        })
        return D.customer_returns(lines, self.rules)

    def cancels(self, period: Period = None) -> DataFrame:
        headers = self._headers(self._and(F.col("o_orderstatus") == "P", self._between("o_orderdate", period)))
        lines = D.document_lines(headers, self._items())
        return lines.withColumns({
            "data_ref": F.col("data_pedido"), "codtipoper": F.lit(3108), "statusnfe": F.lit(None).cast("string"),
        }).filter(D.is_sale_operation(self.rules))

    @staticmethod
    def _kind() -> Column:
        return (
            F.when(F.col("situacao") == "P", F.lit(D.CANCEL))
            .when(F.col("devolvido") == "R", F.lit(D.RETURN))
            .otherwise(F.lit(D.SALE))
        )

    def movements(self, period: Period = None) -> DataFrame:
        """All movements. The whole history is one pass; a period is two pruned scans, because returns are dated
        on the item, sales and cancellations on the order."""
        columns = ["tipo_mov", "nunota", "data_ref", "codemp", "codvend", "codparc", "codprod", "qtdneg", "vlrtot",
                   "vlrdesc", "vlrcus"]
        if period is not None:
            headers = self._headers(self._between("o_orderdate", period))
            ordered = D.document_lines(headers, self._items(cost=True)).withColumns({
                "tipo_mov": self._kind(), "data_ref": F.col("data_pedido")}).filter(F.col("tipo_mov") != D.RETURN)
            returned = self.returns(period).withColumns({"tipo_mov": F.lit(D.RETURN), "vlrcus": F.lit(None).cast("decimal(15,2)")})
            return ordered.select(*columns).unionByName(returned.select(*columns))
        lines = D.document_lines(self._headers(), self._items(cost=True)).withColumn("tipo_mov", self._kind())
        day = F.when(F.col("tipo_mov") == D.RETURN, F.col("data_envio")).otherwise(F.col("data_pedido"))
        return lines.withColumn("data_ref", day).select(*columns)

    # master data ---------------------------------------------------------------------------

    def sellers(self) -> DataFrame:
        return self.table("supplier", "s_suppkey", "s_name").select(
            (F.col("s_suppkey") + 1).alias("codvend"), F.col("s_name").alias("apelido")
        )

    def companies(self) -> DataFrame:
        return self.table("region", "r_regionkey", "r_name").select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("codemp"), F.col("r_name").alias("razaosocial")
        )

    def partners(self) -> DataFrame:
        return self.table("customer", "c_custkey", "c_name").select(
            (F.col("c_custkey") + 1).alias("codparc"), F.col("c_name").alias("nomeparc"), F.lit("S").alias("cliente")
        )

    def products(self, plain_name: bool = False) -> DataFrame:
        """``plain_name`` keeps the ambiguous bare name that name matching has to cope with."""
        code = F.col("p_partkey") + 1
        name = F.col("p_name") if plain_name else F.concat(F.col("p_name"), F.lit(" "), code.cast("string"))
        branded = F.col("p_size") % 25 != 0
        return self.table("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
            code.alias("codprod"),
            name.alias("descrprod"),
            F.when(branded, F.substring("p_brand", 7, 10).cast("bigint")).alias("codmarca"),
            F.when(branded, F.col("p_brand")).alias("marca"),
            F.col("p_type").alias("refforn"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("compldesc"),
        )

    def span(self) -> tuple[date | None, date | None]:
        """First and last day of an order or a shipment, found once per source: two narrow columns."""
        if self._span is None:
            days = self.table("orders", F.to_date("o_orderdate").alias("dia")).unionAll(
                self.table("lineitem", F.to_date("l_shipdate").alias("dia")))
            self._span = tuple(days.agg(F.min("dia"), F.max("dia")).first())
        return self._span

    def _months(self) -> Column:
        """Months of the cycles from that which holds the first day to that which holds the last, so that no day
        of the fact is outside all cycles."""
        def month_of(day: date | None) -> Column:
            return F.trunc(F.add_months(F.date_sub(F.lit(day).cast("date"), 25), 1), "month")

        first, last = self.span()
        return F.explode(F.sequence(month_of(first), month_of(last), F.expr("interval 1 month"))).alias("dtref")

    def goal_cycles(self) -> DataFrame:
        """One cycle per month, from the 26th to the 25th."""
        return self.spark.range(1).select(self._months()).select(
            (F.year("dtref") * 100 + F.month("dtref")).alias("codmetavenda"),
            "dtref",
            F.date_add(F.add_months("dtref", -1), 25).alias("dtinic"),
            F.date_add("dtref", 24).alias("dtfin"),
        )

    def goal_sellers(self) -> DataFrame:
        """A goal and a commission rate for each seller in each cycle."""
        months = self.sellers().select("codvend", self._months())
        step = (F.col("codvend") * 7 + F.month("dtref") * 3) % 11
        cents = (F.lit(100) + (F.col("codvend") % 4) * 25).cast("decimal(3,0)")
        return months.select(
            (F.year("dtref") * 100 + F.month("dtref")).alias("codmetavenda"),
            "codvend",
            (F.lit(100000) + step * 20000).cast("decimal(15,2)").alias("vlrmetavendedor"),
            (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)").alias("perccomissao"),
        )
