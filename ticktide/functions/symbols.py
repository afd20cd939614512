from pyspark.sql import Column, functions as F

PAIR_SPLITTER = "USDT"


def base_currency(symbol: Column) -> Column:
    return F.get(F.split(symbol, PAIR_SPLITTER), F.lit(0))


def quote_currency(symbol: Column) -> Column:
    """Text behind the splitter: empty for ``BTCUSDT``, null when the splitter is missing."""
    return F.get(F.split(symbol, PAIR_SPLITTER), F.lit(1))
