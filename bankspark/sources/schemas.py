"""Declared schemas of the reference's tables (A4), held against every scan by ``contract``.

Columns that its procedures never read are optional.
"""

from pyspark.sql import types as T

_D, _I, _S, _L = T.DateType(), T.IntegerType(), T.StringType(), T.LongType()
RATE = T.DecimalType(18, 6)
MONEY = T.DecimalType(18, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


DEPOSIT = _st(("process_dt", _D), ("account_id", _L), ("account_type", _S), ("customer_type", _S),
              ("interest_rate", RATE), ("vof_rate", RATE), ("balance", _L), ("open_date", _D),
              ("maturity_date", _D), ("close_date", _D), ("day_key", _I), ("funding_id", _I))
LOAN = _st(("process_dt", _D), ("account_id", _L), ("account_type", _S), ("customer_id", _L),
           ("customer_type", _S), ("interest_rate", RATE), ("cof_rate", RATE), ("balance", _L),
           ("open_date", _D), ("maturity_date", _D), ("close_date", _D), ("day_key", _I), ("funding_id", _I))
DEPOSIT_OPTIONAL, LOAN_OPTIONAL = ("customer_type", "close_date"), ("customer_id", "close_date")
LOAN_KPI = _st(("kpi_month", _I), ("pos_city", _S), ("outstanding_principal", MONEY), ("write_off_month", _I),
               ("write_off_balance_principal", MONEY), ("max_bucket", _I))
CITY = _st(("tinh", _S), ("area_code", _S))
GL = _st(("account_code", _S), ("amount", MONEY), ("transaction_date", _D), ("analysis_code", _S))
AREA = _st(("area_code", _S), ("area_name", _S))
SALES_KPI = _st(("sale_name", _S), ("email", _S), ("area_name", _S), ("month", _I),
                ("loan_to_new", MONEY), ("psdn", MONEY), ("app_rate", T.DecimalType(18, 4)))
TICK = _st(("series_id", _S), ("ts", T.TimestampNTZType()), ("event_id", _L), ("close", T.DoubleType()))
MACRO_LONG = _st(("year", _I), ("series_name", _S), ("value", T.DoubleType()))
