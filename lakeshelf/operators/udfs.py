"""One banding as a row UDF and as a vectorised UDF; prefer ``columns.bands``, which needs neither."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A price on a bound belongs to the band above it.
PRICE_BOUNDS = (50_000.0, 150_000.0, 300_000.0)
PRICE_BANDS = ("small", "medium", "large", "bulk")
NO_PRICE = "open"


@F.udf(returnType=StringType())
def price_band(price):
    return NO_PRICE if price is None else PRICE_BANDS[bisect_right(PRICE_BOUNDS, price)]


@F.pandas_udf(StringType())
def price_band_batch(price: pd.Series) -> pd.Series:
    band = np.array(PRICE_BANDS, dtype=object)[np.searchsorted(PRICE_BOUNDS, price.fillna(0.0), side="right")]
    return pd.Series(band, index=price.index).where(price.notna(), NO_PRICE)
