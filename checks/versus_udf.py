"""Built-in expressions against row-at-a-time Python functions: `python -m checks.versus_udf SF_DIR [TIMES]`.

The Python functions state the same results in the plainest way; results are compared first.  TIMES repeats the
alignments.
"""

from __future__ import annotations

import re
import sys
import time

from pyspark.sql import SparkSession, functions as F

from checks import tables as t
from spolia.functions import align, text as txt


def cut(text):
    out, count, current = [], 0, []
    for piece in re.findall(r"\w+|\W+", text):
        current.append(piece)
        count += re.search("[^\\W\\d_]", piece) is not None
        if count == t.MS_LEN:
            out.append("".join(current))
            count, current = 0, []
    return out + (["".join(current)] if current else [])


def equal(s1, s2):
    return sum(a == b != " " for a, b in zip(s1, s2))


def words(s1, s2):
    start, hits = 0, 0
    for word in (s1[:-1] if s1.endswith(" ") else s1).split(" ") if s1 else ():
        hits += s2[start : start + len(word)] == word
        start += len(word) + 1
    return hits


def timed(df):
    best = None
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - start
        best = spent if best is None else min(best, spent)
    return round(best, 2)


if __name__ == "__main__":
    spark = (
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs = t.documents(spark, sys.argv[1]).select("text").cache()
    times = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    pairs = t.alignments(spark, sys.argv[1]).select("s1", "s2").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(times)))).repartition(8).cache()
    print("documents", docs.count(), "alignments", pairs.count(), flush=True)
    text, s1, s2 = F.col("text"), F.col("s1"), F.col("s2")
    builtin = txt.cut_milestones(text, t.MS_LEN, t.TOKEN_CLASS)
    by_udf = F.udf(cut, "array<string>")(text)
    assert docs.where(builtin != by_udf).count() == 0
    print("milestones: built-in", timed(docs.select(builtin)), "python", timed(docs.select(by_udf)), flush=True)
    stats = {
        kernel: pairs.withColumn("m", align.counts(s1, s2, kernel)).select("m.ch", "m.w1")
        for kernel in ("builtin", "arrow")
    }
    python = pairs.select(F.udf(equal, "int")(s1, s2), F.udf(words, "int")(s1, s2))
    assert stats["builtin"].exceptAll(python).count() == 0 and stats["arrow"].exceptAll(python).count() == 0
    print("char and word match:", {k: timed(v) for k, v in stats.items()}, "python", timed(python))
