import datetime as dt

from tidemark.operators import kpi as K
from tidemark.operators import star as S

AS_OF = "2024-01-10 00:00:00"


def test_revenue_boundary_future_and_empty(spark):
    fact = spark.createDataFrame([
        (dt.datetime(2024, 1, 3), 10.0), (dt.datetime(2024, 1, 2, 23), 99.0),
        (dt.datetime(2030, 1, 1), 1.0), (None, 5.0), (dt.datetime(2024, 1, 9), None),
    ], "time_key timestamp_ntz, price double")
    # The bound is inclusive, future rows count, NULL times and prices drop out.
    assert K.total_revenue_last_week(fact, AS_OF).first()[0] == 11.0
    assert K.total_revenue_last_week(fact, "2100-01-01 00:00:00").first()[0] == 0.0


def test_sessions_null_counts_once_and_empty(spark):
    clicks = spark.createDataFrame([
        ("s1", dt.datetime(2024, 1, 9, 12)), ("s1", dt.datetime(2024, 1, 9, 13)),
        (None, dt.datetime(2024, 1, 9, 14)), (None, dt.datetime(2024, 1, 9, 15)),
    ], "session_id string, event_timestamp timestamp_ntz")
    assert K.active_sessions_last_1_day(clicks, AS_OF).first()[0] == 2
    assert K.active_sessions_last_15_minutes(clicks, AS_OF).first()[0] == 0


def test_kpi_dispatch(spark):
    fact = spark.createDataFrame([(dt.datetime(2024, 1, 9), 2.5)], "time_key timestamp_ntz, price double")
    assert tuple(K.kpi("total_revenue", fact_orders=fact, as_of=AS_OF).first()) == ("total_revenue", 2.5)


def test_star_schema_shapes(spark):
    b = spark.createDataFrame([
        ("1", "agency1", "Ann", "VA1", dt.datetime(2024, 1, 1, 5, 0, 0, 123), dt.datetime(2024, 1, 2), 10.0, "USD", "ok"),
        ("2", "agency1", "Ann", "VA1", dt.datetime(2024, 1, 1, 5, 0, 0, 123), dt.datetime(2024, 1, 2), 12.0, "EUR", "ok"),
    ], "booking_id string, agency_id string, customer_name string, flight_number string, departure_date timestamp_ntz, "
       "arrival_date timestamp_ntz, price double, currency string, status string")
    st = S.star_schema(b)
    assert st.dim_time.count() == 1 and st.dim_customer.count() == 1
    assert st.dim_product.count() == 2 and st.fact_orders.count() == 2
    assert st.dim_time.first()["time_key"].microsecond == 123
    assert [f.dataType.simpleString() for f in st.dim_time.schema.fields][1:] == ["tinyint"] * 3 + ["int"]
