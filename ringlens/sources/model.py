"""Logical report tables over the physical parquet tables.

Every accessor is a lazy projection, so filters and column pruning reach the scan.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def named(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Project ``new_name=old_column`` pairs."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    )


@dataclass(frozen=True)
class Model:
    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def sites(self) -> DataFrame:
        return named(self.table("region"), site_id="r_regionkey", site_name="r_name")

    def campaigns(self) -> DataFrame:
        return named(
            self.table("nation"),
            campaign_id="n_nationkey",
            campaign_name="n_name",
            site_id="n_regionkey",
        )

    def contacts(self) -> DataFrame:
        """Contact, visitor and person share one table; the phone is derived from the id."""
        return named(
            self.table("customer"),
            contact_id="c_custkey",
            contact_name="c_name",
            campaign_id="c_nationkey",
            segment="c_mktsegment",
            balance="c_acctbal",
        )

    def employees(self) -> DataFrame:
        return named(
            self.table("supplier"),
            employee_id="s_suppkey",
            employee_name="s_name",
            group_id="s_nationkey",
        )

    def numbers(self) -> DataFrame:
        return named(
            self.table("part"),
            number_id="p_partkey",
            number_name="p_name",
            brand="p_brand",
            category="p_type",
            size="p_size",
            charge="p_retailprice",
        )

    def calls(self) -> DataFrame:
        """Call sessions; the same rows serve as deals (status = stage)."""
        return named(
            self.table("orders"),
            call_id="o_orderkey",
            contact_id="o_custkey",
            start_time="o_orderdate",
            status="o_orderstatus",
            revenue="o_totalprice",
            tag="o_orderpriority",
        )

    def legs(self) -> DataFrame:
        return named(
            self.table("lineitem"),
            call_id="l_orderkey",
            leg_no="l_linenumber",
            employee_id="l_suppkey",
            number_id="l_partkey",
            duration="l_quantity",
            charge="l_extendedprice",
            bonus_rate="l_discount",
            fee_rate="l_tax",
            finish_reason="l_returnflag",
            direction="l_linestatus",
            leg_time="l_shipdate",
        )

    def events(self) -> DataFrame:
        return named(
            self.table("events"),
            event_id="event_id",
            date_time="ts",
            visitor_id="user_id",
            kind="event_type",
            amount="value",
            properties="props",
        )

    def messages(self) -> DataFrame:
        return named(
            self.table("conversations"), chat_id="conv_id", turn="turn", role="role", text="text"
        )

    def transcripts(self) -> DataFrame:
        return named(
            self.table("documents"),
            transcript_id="doc_id",
            text="text",
            lang="lang",
            source="source",
            n_chars="n_chars",
        )

    def pages(self) -> DataFrame:
        return self.table("pages")

    def calls_wide(self) -> DataFrame:
        """Calls with contact, campaign and site columns; unmatched keys are kept."""
        return self.calls().join(self.contacts_wide(), "contact_id", "left")

    def contacts_wide(self) -> DataFrame:
        """Contacts with campaign and site columns."""
        return (
            self.contacts()
            .join(self.campaigns(), "campaign_id", "left")
            .join(self.sites(), "site_id", "left")
        )


def phone(contact_id: Column) -> Column:
    """Derived E.164 number of a contact."""
    return F.concat(F.lit("7"), F.lpad(contact_id.cast("string"), 10, "0"))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of an input of few partitions to more tasks, for work heavy per row.

    AQE reads as many of the dealt partitions together as its advisory size says, so this
    neither depends on the cluster's cores nor makes tiny tasks; an input that comes in
    more partitions than a shuffle has is left as it is.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
