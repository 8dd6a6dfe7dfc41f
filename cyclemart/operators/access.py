"""Row access by role. Unknown roles and inactive users see nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.functions.predicates import Company

ADMIN, MANAGER, SELLER = "ADMIN", "MANAGER", "SELLER"


@dataclass(frozen=True)
class User:
    role: str
    seller_id: int | None = None
    companies: tuple[int, ...] = ()
    is_active: bool | None = True

    @property
    def kind(self) -> str | None:
        """The role, or None where nothing is allowed. An unset active flag counts as active."""
        role = self.role.strip().upper()
        return role if role in (ADMIN, MANAGER, SELLER) and self.is_active is not False else None


@dataclass(frozen=True)
class Scope:
    """What a request may read: pass it on as the query's filters."""

    allowed: bool
    company: Company = None
    seller_ids: tuple[int, ...] | None = None


DENIED = Scope(False, company=())


def kpi_scope(user: User, company: int | None = None, seller: int | None = None) -> Scope:
    """KPI page. A manager without a choice gets all managed companies; a company outside them gets
    nothing; a seller sees only themself."""
    chosen = (seller,) if seller else None
    if user.kind == ADMIN:
        return Scope(True, company or None, chosen)
    if user.kind == MANAGER:
        if company and company not in user.companies:
            return DENIED
        return Scope(True, company or tuple(user.companies), chosen) if user.companies else DENIED
    if user.kind == SELLER and user.seller_id is not None:
        return Scope(True, company or None, (user.seller_id,))
    return DENIED


def seller_list_scope(user: User, company: int | None = None) -> Scope:
    """Seller choice list: as the KPI page, but filtered to the user only at the end."""
    return kpi_scope(user, company)


def ranking_scope(user: User, company: int | None = None, seller: int | None = None) -> Scope:
    """Rankings. A manager who asks for a company outside the managed ones gets all managed ones; a
    seller reads the lists over all companies. Company 0 stands for all."""
    chosen = (seller or 0,)
    if user.kind == ADMIN:
        return Scope(True, company or 0, chosen)
    if user.kind == MANAGER and user.companies:
        return Scope(True, company if company in user.companies else tuple(user.companies), chosen)
    if user.kind == SELLER and user.seller_id is not None:
        return Scope(True, 0, (user.seller_id,))
    return DENIED


def profile_scope(user: User, company: int = 0, seller: int = 0) -> Scope:
    """Profiles. A manager outside the managed companies falls back to the first of them."""
    if user.kind == ADMIN:
        return Scope(True, company, (seller,))
    if user.kind == MANAGER and user.companies:
        return Scope(True, company if company in user.companies else user.companies[0], (seller,))
    if user.kind == SELLER and user.seller_id is not None:
        return Scope(True, company, (user.seller_id,))
    return DENIED


def allowed_sellers(found: DataFrame, user: User) -> DataFrame:
    """A manager's list comes filtered by company already."""
    if user.kind == SELLER and user.seller_id is not None:
        return found.filter(F.col("id_vendedor") == user.seller_id)
    return found if user.kind in (ADMIN, MANAGER) else found.filter(F.lit(False))


def active_policies(policies: DataFrame) -> DataFrame:
    return policies.filter(F.coalesce("is_active", F.lit(True)))


def policy_rows(rows: DataFrame, policies: DataFrame) -> DataFrame:
    """Rows each manager and seller may read, for all users at once: grants join on the company or
    on the seller. Administrators read everything and need no join."""
    active = active_policies(policies).withColumn("role", F.upper(F.trim("role")))
    managed = active.filter(F.col("role") == MANAGER).select(
        "username", F.explode(F.col("managed_sellers").cast("array<bigint>")).alias("id_empresa")
    ).distinct()
    own = active.filter((F.col("role") == SELLER) & F.col("seller_id").isNotNull()).select(
        "username", F.col("seller_id").cast("bigint").alias("id_vendedor")
    )
    by_company = rows.join(managed, "id_empresa")
    by_seller = rows.join(own, "id_vendedor")
    return by_company.unionByName(by_seller)


#: Session variable that names who reads.
READER = "leitor"


def session_view(rows: DataFrame, policies: DataFrame, name: str) -> str:
    """A view of ``rows`` that shows each reader of the session what their policy allows: all to administrators, their
    companies to managers, their own rows to sellers, nothing to others, inactive ones or without ``set_reader``.

    The policy is looked up once per query as a scalar, so the rows are filtered in the scan and joined with nothing.
    """
    spark = rows.sparkSession
    spark.sql(f"DECLARE OR REPLACE VARIABLE {READER} STRING DEFAULT NULL")
    rows.createOrReplaceTempView(f"{name}_linhas")
    active_policies(policies).select(
        "username", F.upper(F.trim("role")).alias("role"), F.col("seller_id").cast("bigint").alias("seller_id"),
        F.col("managed_sellers").cast("array<bigint>").alias("companies")).createOrReplaceTempView(f"{name}_politicas")

    def mine(column: str) -> str:
        return f"(SELECT max({column}) FROM {name}_politicas WHERE username = {READER})"

    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {name}_linhas WHERE CASE {mine("role")}
        WHEN '{ADMIN}' THEN true
        WHEN '{MANAGER}' THEN array_contains({mine("companies")}, id_empresa)
        WHEN '{SELLER}' THEN id_vendedor = {mine("seller_id")}
        ELSE false END""")
    return name


def set_reader(spark: SparkSession, username: str | None) -> None:
    spark.sql(f"SET VAR {READER} = :reader", args={"reader": username})


def users_from(policies: Sequence) -> dict[str, User]:
    """User objects for policy rows the caller has looked up by name."""
    return {
        p["username"]: User(p["role"], p["seller_id"], tuple(p["managed_sellers"] or ()), p["is_active"])
        for p in policies
    }
