"""Window functions (W)."""

from pyspark.sql import functions as F

from ..operators.cuts import tiles_by_cuts
from ..operators.windows import (
    dense_ids,
    lagged,
    moving_average,
    range_totals,
    row_frames,
    running_totals,
    top_n_per_group,
)
from ..plans.curated import market_parsed
from ..sources.tables import TXN_TIE
from . import build
from .registry import query

TIE_SQL = ", ".join(TXN_TIE)


def _txn_time():
    return F.unix_micros(F.col("txn_date").cast("timestamp"))


def _txns(t):
    """The columns that the order and the results need: what is left out before costs no shuffle."""
    return t.plain_transactions().select("account_id", "txn_id", "part_id", "supplier_id", "line_number", *[c for c in TXN_TIE if c not in ("part_id", "supplier_id", "line_number")])


def _txn_order():
    return [F.asc_nulls_last(c) for c in TXN_TIE]


@query(
    "w01_keep_first_per_group",
    f"""SELECT account_id, txn_id, part_id, CAST(amount AS DOUBLE) AS amount FROM transactions
       QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY amount DESC, {TIE_SQL}) = 1""",
)
def w01(t):
    top = top_n_per_group(t.plain_transactions(), ["account_id"], [F.desc_nulls_last("amount"), *_txn_order()])
    return top.select("account_id", "txn_id", "part_id", F.col("amount").cast("double").alias("amount"))


@query(
    "w02_rank_with_ties",
    """SELECT customer_id, account_id, CAST(RANK() OVER (PARTITION BY customer_id ORDER BY opened_date DESC) AS INTEGER)
       AS account_rank FROM accounts QUALIFY account_rank <= 2""",
)
def w02(t):
    r = top_n_per_group(
        t.accounts(), ["customer_id"], [F.desc_nulls_last("opened_date")], 2, ties="rank", rank_col="account_rank"
    )
    return r.select("customer_id", "account_id", "account_rank")


SIGNED_SQL = "CASE WHEN txn_type IN ('CREDIT', 'TRANSFER') THEN amount WHEN txn_type = 'DEBIT' THEN -amount ELSE 0 END"


@query(
    "w03_running_balance",
    f"""SELECT account_id, txn_id, part_id, supplier_id, line_number, CAST(amount AS DOUBLE) AS amount,
        CAST(SUM({SIGNED_SQL}) OVER (PARTITION BY account_id ORDER BY {TIE_SQL}
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_balance FROM transactions""",
)
def w03(t):
    kind, amount = F.col("txn_type"), F.col("amount")
    signed = F.when(kind.isin("CREDIT", "TRANSFER"), amount).when(kind == "DEBIT", -amount).otherwise(0)
    r = running_totals(_txns(t), ["account_id"], _txn_order(), _txn_time(), {"running_balance": signed})
    return build.doubles(r, "amount", "running_balance").select(
        "account_id", "txn_id", "part_id", "supplier_id", "line_number", "amount", "running_balance"
    )


@query(
    "w04_moving_averages",
    """SELECT market_data_id, ticker, close_price, ROUND(AVG(close_price) OVER w7, 6) AS ma_7d,
              ROUND(AVG(close_price) OVER w30, 6) AS ma_30d, volume, rsi FROM market_data
       WINDOW w7 AS (PARTITION BY ticker ORDER BY trade_date, market_data_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
              w30 AS (PARTITION BY ticker ORDER BY trade_date, market_data_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def w04(t):
    m = market_parsed(t.market_data()).select("market_data_id", "ticker", "trade_date", "close_price", "volume", "rsi")
    r = row_frames(
        m,
        ["ticker"],
        [F.asc("trade_date"), F.asc("market_data_id")],
        F.unix_micros(F.col("trade_date").cast("timestamp")),
        {"ma_7d": moving_average("close_price", 7), "ma_30d": moving_average("close_price", 30)},
    )
    return r.select(
        "market_data_id", "ticker", "close_price", F.round("ma_7d", 6).alias("ma_7d"),
        F.round("ma_30d", 6).alias("ma_30d"), "volume", "rsi",
    )


@query(
    "w05_velocity_1h",
    """SELECT event_id, user_id, COUNT(*) OVER w AS events_last_hour,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS amount_last_hour FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def w05(t):
    e = t.raw("events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("amount"))
    r = range_totals(e, ["user_id"], "ts", 3600, {"events_last_hour": F.lit(1), "amount_last_hour": F.col("amount")})
    return build.doubles(r, "amount_last_hour").select("event_id", "user_id", "events_last_hour", "amount_last_hour")


@query(
    "w06_global_ntile",
    """SELECT account_id, CAST(NTILE(5) OVER (ORDER BY balance, account_id) AS INTEGER) AS balance_quintile FROM accounts""",
)
def w06(t):
    a = t.accounts().select("account_id", "balance")
    return tiles_by_cuts(a, 5, {"balance_quintile": (F.col("balance"), F.col("account_id"))}).drop("balance")


@query(
    "w07_sequence_per_group",
    f"""SELECT account_id, txn_id, part_id, supplier_id, line_number,
        ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY {TIE_SQL}) AS txn_sequence FROM transactions""",
)
def w07(t):
    r = running_totals(_txns(t), ["account_id"], _txn_order(), _txn_time(), sequence="txn_sequence")
    return r.select("account_id", "txn_id", "part_id", "supplier_id", "line_number", "txn_sequence")


@query(
    "w08_lags",
    """SELECT event_id, user_id, LAG(value, 1) OVER w AS lag_1, LAG(value, 2) OVER w AS lag_2, LAG(value, 3) OVER w AS lag_3
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def w08(t):
    e = t.raw("events").select("event_id", "user_id", "ts", "value")
    r = row_frames(
        e,
        ["user_id"],
        [F.asc("ts"), F.asc("event_id")],
        F.unix_micros(F.col("ts").cast("timestamp")),
        {f"lag_{k}": lagged("value", k) for k in (1, 2, 3)},
    )
    return r.select("event_id", "user_id", "lag_1", "lag_2", "lag_3")


@query(
    "w09_rolling_mean_full",
    """SELECT event_id, user_id, CASE WHEN ROW_NUMBER() OVER w >= 3 THEN ROUND(AVG(value) OVER
              (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) END AS rolling_3
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def w09(t):
    e = t.raw("events").select("event_id", "user_id", "ts", "value")

    def full_mean(w):
        frame = w.rowsBetween(-2, 0)
        return F.when(F.count(F.lit(1)).over(frame) >= 3, F.avg("value").over(frame))

    r = row_frames(
        e, ["user_id"], [F.asc("ts"), F.asc("event_id")], F.unix_micros(F.col("ts").cast("timestamp")), {"rolling_3": (2, full_mean)}
    )
    return r.select("event_id", "user_id", F.round("rolling_3", 6).alias("rolling_3"))


@query(
    "w10_period_change",
    """SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month, CAST(monthly_volume AS DOUBLE) AS volume,
              CAST(monthly_volume AS DOUBLE) / LAG(CAST(monthly_volume AS DOUBLE)) OVER (ORDER BY revenue_month) - 1
              AS growth FROM monthly""",
)
def w10(t):
    from pyspark.sql import Window

    # One row per month: the unpartitioned window is bounded by the calendar.
    w = Window.partitionBy(F.lit(0)).orderBy("revenue_month")
    m = build.doubles(build.monthly(t), "monthly_volume")
    m = m.withColumn("growth", F.col("monthly_volume") / F.lag("monthly_volume").over(w) - 1)
    return build.days(m, "revenue_month").select("revenue_month", F.col("monthly_volume").alias("volume"), "growth")


@query(
    "w11_window_over_alias",
    """SELECT customer_id, account_id, age_days, CAST(ROW_NUMBER() OVER (PARTITION BY customer_id
              ORDER BY age_days DESC, account_id) AS INTEGER) AS age_rank
       FROM (SELECT customer_id, account_id, DATE_DIFF('day', opened_date, DATE '2001-12-31') AS age_days FROM accounts)
       QUALIFY age_rank <= 3""",
)
def w11(t):
    from ..functions.compat import date_diff

    a = t.accounts().select(
        "customer_id", "account_id", date_diff("day", "opened_date", build.as_of()).alias("age_days")
    )
    return top_n_per_group(
        a, ["customer_id"], [F.desc("age_days"), F.asc("account_id")], 3, rank_col="age_rank"
    )


@query(
    "s21_surrogate_keys",
    """SELECT ROW_NUMBER() OVER (ORDER BY doc_id DESC) + 1000 AS alert_id, doc_id FROM documents""",
)
def s21(t):
    return dense_ids(t.raw("documents").select("doc_id"), [F.desc("doc_id")], "alert_id", start=1001)
