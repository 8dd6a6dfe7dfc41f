from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclemart.config import HOLIDAYS
from cyclemart.functions.calendar import cycle_days, cycle_label, working_days
from cyclemart.operators.performance import cycle_options, parse_cycle

DAYS = st.dates(date(1960, 1, 1), date(2040, 12, 31))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(DAYS, st.integers(0, 400)), min_size=1, max_size=30))
def test_working_days_equal_counting(spark, spans):
    rows = [(a, a + timedelta(days=n)) for a, n in spans] + [(date(2025, 12, 20), date(2026, 2, 28))]
    df = spark.createDataFrame(rows, "a date, b date")
    got = [r.n for r in df.select(working_days(F.col("a"), F.col("b"), HOLIDAYS).alias("n")).collect()]

    def count(a, b):
        return sum(
            (a + timedelta(days=i)).weekday() < 6 and (a + timedelta(days=i)) not in HOLIDAYS for i in range((b - a).days + 1)
        )

    assert got == [count(a, b) for a, b in rows]


def test_cycle_days_and_label(spark):
    cycles = spark.createDataFrame([(date(2026, 3, 1), date(2026, 2, 26), date(2026, 3, 25), None)],
                                   "dtref date, dtinic date, dtfin date, label string")
    days = cycle_days(cycles, HOLIDAYS)
    assert days.count() == 28
    assert days.filter("not dia_util").count() == 4
    assert cycles.select(cycle_label(F.col("dtref")).alias("l")).first().l == "Março / 2026"
    option = cycle_options(cycles).first()
    assert (option.label, option.value) == ("03/2026", "2026-02-26|2026-03-25|2026-03-01")
    back = cycle_options(cycles).select(parse_cycle(F.col("value")).alias("c")).first().c
    assert (back.dtinic, back.dtfin, back.dtref) == (date(2026, 2, 26), date(2026, 3, 25), date(2026, 3, 1))
