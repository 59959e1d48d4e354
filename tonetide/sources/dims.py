"""Literal ticker -> sector dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The reference's 110 tickers and their sectors, in its order.
TICKER_CATEGORIES = {
    "AAPL": "Tech", "MSFT": "Tech", "GOOGL": "Tech", "FB": "Tech", "IBM": "Tech",
    "NVDA": "Tech", "INTC": "Tech", "AMD": "Tech", "ORCL": "Tech", "SAP": "Tech",

    "PFE": "Pharmaceutical", "JNJ": "Pharmaceutical", "MRK": "Pharmaceutical", "GSK": "Pharmaceutical", "NVS": "Pharmaceutical",
    "ABBV": "Pharmaceutical", "BMY": "Pharmaceutical", "AMGN": "Pharmaceutical", "SNY": "Pharmaceutical", "LLY": "Pharmaceutical",

    "JPM": "Financial", "BAC": "Financial", "WFC": "Financial", "C": "Financial", "GS": "Financial",
    "MS": "Financial", "AXP": "Financial", "BRK.B": "Financial", "TFC": "Financial", "SPGI": "Financial",

    "XOM": "Oil", "CVX": "Oil", "RDS.A": "Oil", "BP": "Oil", "TOT": "Oil",
    "PBR": "Oil", "ENB": "Oil", "E": "Oil", "SLB": "Oil", "COP": "Oil",

    "AMZN": "Retail", "WMT": "Retail", "HD": "Retail", "COST": "Retail", "TGT": "Retail",
    "LOW": "Retail", "JD": "Retail", "EBAY": "Retail", "ORLY": "Retail", "BBY": "Retail",

    "TSLA": "Automotive", "GM": "Automotive", "F": "Automotive", "HMC": "Automotive", "TM": "Automotive",
    "VWAGY": "Automotive", "DAI.DE": "Automotive", "RACE": "Automotive", "TTM": "Automotive", "STLA": "Automotive",

    "T": "Telecommunications", "VZ": "Telecommunications", "NOK": "Telecommunications", "ERIC": "Telecommunications", "CHT": "Telecommunications",
    "CHA": "Telecommunications", "TLK": "Telecommunications", "TELIA.ST": "Telecommunications", "BCE": "Telecommunications", "S": "Telecommunications",

    "BA": "Aerospace", "LMT": "Aerospace", "RTX": "Aerospace", "NOC": "Aerospace", "GD": "Aerospace",
    "AIR.PA": "Aerospace", "BAE.L": "Aerospace", "HEI": "Aerospace", "COL": "Aerospace", "SAFRY": "Aerospace",

    "SPG": "Real Estate", "AMT": "Real Estate", "PLD": "Real Estate", "CCI": "Real Estate", "EQIX": "Real Estate",
    "DLR": "Real Estate", "WELL": "Real Estate", "AVB": "Real Estate", "O": "Real Estate", "GPT": "Real Estate",

    "DIS": "Entertainment", "NFLX": "Entertainment", "CMCSA": "Entertainment", "CHTR": "Entertainment", "LBRDK": "Entertainment",
    "VIAC": "Entertainment", "LYV": "Entertainment", "FOXA": "Entertainment", "DISH": "Entertainment", "ROKU": "Entertainment",

    "NKE": "Apparel", "UAA": "Apparel", "LULU": "Apparel", "PVH": "Apparel", "VFC": "Apparel",
    "RL": "Apparel", "DECK": "Apparel", "CROX": "Apparel", "GIL": "Apparel", "SKX": "Apparel",
}


def ticker_dim(spark: SparkSession) -> DataFrame:
    """(Stock, Category) for the literal ticker list: 110 rows, a bounded dimension."""
    return spark.createDataFrame(list(TICKER_CATEGORIES.items()), "Stock string, Category string")
