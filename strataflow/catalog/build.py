"""Layer tables built over one set of base tables, with a literal as-of date."""

from pyspark.sql import functions as F

from ..operators.distinct import Domain
from ..plans import consumption, curated
from ..sources.tables import CHANNELS

AS_OF_DATE = "2001-12-31"
AS_OF_TICKETS = "2024-02-01 00:30:00"


def as_of():
    return F.lit(AS_OF_DATE).cast("date")


def profile(t):
    return curated.customer_profile(t.customers(), t.accounts(), t.risk_assessments())


def enriched(t):
    return curated.transaction_enriched(t.transactions(), t.accounts(), t.customers())


def lean_enriched(t):
    """Enriched transactions with category but without the merchant lookup."""
    return curated.transaction_enriched(t.categorised_transactions(), t.accounts(), t.customers())


def plain_enriched(t):
    """Enriched transactions without merchant and category."""
    return curated.transaction_enriched(t.plain_transactions(), t.accounts(), t.customers())


def categories(t):
    """The categories, from the small table that names them."""
    return Domain.of(t.raw("part").select(F.col("p_type").alias("category")))


def channels(t):
    return Domain.of(t.spark.createDataFrame([(c,) for c in CHANNELS], "channel string"))


def c360(t):
    return consumption.customer_360(profile(t), enriched(t), t.tickets(), as_of(), categories(t))


def daily(t):
    return consumption.daily_financial_metrics(plain_enriched(t))


def channel_daily(t):
    return consumption.channel_performance(lean_enriched(t), categories=categories(t))


def monthly(t):
    return consumption.monthly_revenue(daily(t))


def risk_board(t):
    return consumption.risk_dashboard(profile(t))


def churn(t):
    return consumption.churn_features(c360(t), as_of())


def doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def texts(df, *cols):
    """Dates and times as text, so both engines print the same value."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


def days(df, *cols):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})
