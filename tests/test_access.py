from datetime import date
from decimal import Decimal

import pytest

from cyclemart.operators import access as A

ADMIN, MANAGER, SELLER = A.User("admin"), A.User("Manager", companies=(1, 2)), A.User("SELLER", seller_id=3)
GUEST, GONE, IDLE = A.User("GUEST"), A.User("ADMIN", is_active=False), A.User("MANAGER")


@pytest.mark.parametrize("user, company, seller, scope", [
    (ADMIN, None, None, A.Scope(True, None, None)), (ADMIN, 4, 7, A.Scope(True, 4, (7,))),
    (MANAGER, None, None, A.Scope(True, (1, 2), None)), (MANAGER, 2, None, A.Scope(True, 2, None)), (MANAGER, 4, None, A.DENIED),
    (SELLER, None, 9, A.Scope(True, None, (3,))), (GUEST, None, None, A.DENIED), (GONE, None, None, A.DENIED),
    (A.User("ADMIN", is_active=None), None, None, A.Scope(True, None, None)),
])
def test_kpi_scope(user, company, seller, scope):
    assert A.kpi_scope(user, company, seller) == scope


def test_manager_without_companies_sees_nothing():
    assert not A.kpi_scope(IDLE).allowed and A.kpi_scope(IDLE).company == ()
    assert A.kpi_scope(IDLE, seller=3) == A.DENIED and A.kpi_scope(IDLE, 1, 3) == A.DENIED
    assert A.ranking_scope(IDLE) == A.DENIED and A.profile_scope(IDLE) == A.DENIED


@pytest.mark.parametrize("user, company, scope", [
    (ADMIN, None, A.Scope(True, 0, (0,))), (MANAGER, 2, A.Scope(True, 2, (0,))), (MANAGER, 4, A.Scope(True, (1, 2), (0,))),
    (MANAGER, None, A.Scope(True, (1, 2), (0,))), (SELLER, 4, A.Scope(True, 0, (3,))), (GUEST, None, A.DENIED),
])
def test_ranking_scope(user, company, scope):
    assert A.ranking_scope(user, company) == scope


def test_profile_scope():
    assert A.profile_scope(MANAGER, 4, 9) == A.Scope(True, 1, (9,))
    assert A.profile_scope(MANAGER, 2) == A.Scope(True, 2, (0,))
    assert A.profile_scope(SELLER, 4, 9) == A.Scope(True, 4, (3,))
    assert A.profile_scope(GUEST) == A.DENIED


def test_seller_lists_and_rows(spark):
    found = spark.createDataFrame([(1, "A"), (3, "B")], "id_vendedor bigint, nome_comercial string")
    ids = {u: [r.id_vendedor for r in A.allowed_sellers(found, u).collect()] for u in (ADMIN, MANAGER, SELLER, GUEST)}
    assert ids == {ADMIN: [1, 3], MANAGER: [1, 3], SELLER: [3], GUEST: []}


def test_policy_table(spark):
    policies = spark.createDataFrame(
        [("m", "manager", None, [1, 1, 4], None), ("s", "SELLER", 3, None, True), ("x", "SELLER", 1, None, False), ("a", "ADMIN", None, None, True)],
        "username string, role string, seller_id int, managed_sellers array<int>, is_active boolean")
    fact = spark.createDataFrame([(date(2026, 1, 1), 1, 1, Decimal(5)), (date(2026, 1, 1), 3, 2, Decimal(7)), (date(2026, 1, 1), 3, 4, Decimal(1))],
                                 "d date, id_vendedor bigint, id_empresa bigint, v decimal(9,2)")
    seen = sorted((r.username, r.id_vendedor, r.id_empresa) for r in A.policy_rows(fact, policies).collect())
    assert seen == [("m", 1, 1), ("m", 3, 4), ("s", 3, 2), ("s", 3, 4)]
    users = A.users_from(policies.collect())
    assert users["m"].companies == (1, 1, 4) and users["x"].kind is None and users["m"].kind == "MANAGER"


def test_one_view_for_every_reader(spark, plan):
    policies = spark.createDataFrame(
        [("m", " manager", None, [1, 4], None), ("s", "SELLER", 3, None, True), ("x", "SELLER", 1, None, False), ("a", "admin", None, None, True), ("n", "MANAGER", None, None, True)],
        "username string, role string, seller_id int, managed_sellers array<int>, is_active boolean")
    fact = spark.createDataFrame([(1, 1), (3, 2), (3, 4), (9, None)], "id_vendedor bigint, id_empresa bigint")
    view = A.session_view(fact, policies, "test_permitido")
    assert spark.table(view).count() == 0
    seen = {}
    for reader in ("a", "m", "s", "x", "n", "who", "a' OR '1'='1", None):
        A.set_reader(spark, reader)
        seen[reader] = sorted(((r.id_vendedor, r.id_empresa) for r in spark.table(view).collect()), key=str)
        assert "Join" not in plan(spark.table(view))
    A.set_reader(spark, None)
    assert seen == {"a": [(1, 1), (3, 2), (3, 4), (9, None)], "m": [(1, 1), (3, 4)], "s": [(3, 2), (3, 4)], "x": [], "n": [], "who": [],
                    "a' OR '1'='1": [], None: []}
