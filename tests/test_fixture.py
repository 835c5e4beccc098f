"""The inputs derived from the driver tables leave nothing out."""

from pyspark.sql import functions as F

from checks import tables as t

SF = "/root/testdata/sf0.001"


def test_alignments_hold_whole_texts(spark):
    df = t.alignments(spark, SF)
    per_pair = df.groupBy("uid1", "uid2").agg(
        *[F.max(f"len{s}").alias(f"len{s}") for s in (1, 2)], *[F.sum(F.col(f"e{s}") - F.col(f"b{s}")).alias(f"in{s}") for s in (1, 2)]
    ).collect()
    assert per_pair and all((r.len1, r.len2) == (r.in1, r.in2) for r in per_pair)


def test_every_copy_with_a_partner_in_another_source_is_linked(spark):
    docs = t.table(spark, SF, "documents").collect()
    groups = {}
    for d in docs:
        groups.setdefault(d.text.split("\n", 1)[0], []).append(d)
    want = 0
    for group in groups.values():
        first = min(group, key=lambda d: d.doc_id)
        if any(d.source != first.source for d in group):
            want += len(group) - 1
    assert t.alignments(spark, SF).select("uid1", "uid2").distinct().count() == want
