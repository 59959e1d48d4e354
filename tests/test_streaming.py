"""The streaming daily tone equals the batch daily tone on the same landed files."""

import os
import tempfile

from pyspark.sql import functions as F

from tonetide.operators import tone
from tonetide.sources import fixtures as fx
from tonetide.streaming import tone_stream

from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="tonetide-stream-")
    src, sink = os.path.join(root, "landing"), os.path.join(root, "daily")
    ev = fx.events_in(spark, SF_SMALL)
    # land the whole feed as two arrivals: first half of the month, then the rest
    ev.where(F.dayofmonth(F.to_date(F.col("Day").cast("string"), "yyyyMMdd")) <= 15).write.parquet(os.path.join(src, "a"))
    ev.where(F.dayofmonth(F.to_date(F.col("Day").cast("string"), "yyyyMMdd")) > 15).write.parquet(os.path.join(src, "b"))
    q = tone_stream.start_daily_tone(spark, src + "/*", sink, checkpoint=os.path.join(root, "ckpt"),
                                     output_mode="update", available_now=True, watermark="400 days")
    q.awaitTermination(300)
    got = spark.read.parquet(sink).select("Date", "num", "avg_tone", "median_tone")
    want = tone.tone_daily_stats(tone.dedup_url(tone.country(ev, "US")), count_nulls=True)
    want = want.select("Date", "num", "avg_tone", "median_tone")
    r = lambda df: sorted((x.Date, x.num, round(x.avg_tone, 9), round(x.median_tone, 9)) for x in df.collect())
    assert r(got) == r(want)
