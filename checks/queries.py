"""The registered queries: each operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import tables as t
from spolia import config
from spolia.config import CorpusConfig
from spolia.functions import align, letters, text as txt, uri
from spolia.operators import alignments as al, bookstats as bs, corpus, milestones as ms, pairwise as pw, ranges as rg, records as rec
from spolia.operators.once import computed_once, exploded
from spolia.plans import pairwise, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- corpus -----------------------------------------------------------------------------


@query
def uri_parse(spark, d):
    return t.corpus_files(spark, d).select(
        "file_name", "author", "title", "book_uri", "series", "version", "part", "lang", "ext", "lang_ext",
        uri.short_id(F.col("series")).alias("short_id"),
    )


@query
def name_filter(spark, d):
    """French documents get a name that does not follow the scheme."""
    candidates = t.corpus_files(spark, d).withColumn(
        "file_name", F.concat("file_name", F.when(F.col("doc_lang") == "fr", ".bak").otherwise(""))
    )
    return corpus.filter_names(candidates).select("doc_id", "file_name")


@query
def header_split(spark, d):
    parts = t.corpus_files(spark, d).select("file_name", txt.split_header(F.col("value")).alias("p"))
    return parts.select("file_name", "p.header", "p.marker", "p.body")


@query
def primary_filter(spark, d):
    kept = corpus.filter_primary(t.corpus_files(spark, d), t.version_metadata(spark, d))
    return kept.select("file_name", "version")


@query
def select_version(spark, d):
    return corpus.select_version(t.corpus_files(spark, d)).select("file_name", "ext", "part", "value")


@query
def version_per_folder(spark, d):
    """Documents dealt to three folders; a version is chosen in each."""
    files = t.corpus_files(spark, d).withColumn("path", F.concat(F.lit("f"), F.expr("doc_id % 3"), F.lit("/"), "file_name"))
    return corpus.select_version(files, by_folder=True).select("path", "value")


@query
def export_rejects(spark, d):
    """French documents have no splitter; some of them are parts of books."""
    files = t.corpus_files(spark, d).withColumn(
        "value", F.when(F.col("doc_lang") == "fr", F.replace("value", F.lit(config.SPLITTER), F.lit(""))).otherwise(F.col("value"))
    )
    judged = corpus.with_reason(corpus.select_version(files, files.drop("value")))
    return judged.where("reason is not null").select("file_name", "reason")


@query
def merge_parts(spark, d):
    return corpus.merge_parts(corpus.with_body(corpus.select_version(t.corpus_files(spark, d)))).select(
        "series", "book_uri", "version", "body"
    )


@query
def corpus_log(spark, d):
    return corpus.corpus_log(corpus.select_version(t.corpus_files(spark, d)), t.earlier_output(spark, d))


@query
def skip_existing(spark, d):
    return corpus.skip_existing(t.corpus_files(spark, d), t.earlier_output(spark, d)).select("series", "file_name")


# --- milestones -------------------------------------------------------------------------


@query
def strip_milestones(spark, d):
    docs = t.documents(spark, d)
    return docs.select("doc_id", txt.strip_milestones(t.tagged_text(F.col("text"))).alias("body"))


@query
def residual_tags(spark, d):
    stripped = t.documents(spark, d).select(
        "doc_id", txt.strip_milestones(t.overlapping_tags(F.col("text"))).alias("body")
    )
    return stripped.select("doc_id", txt.residual_tags(F.col("body")).alias("left_over"))


@query
def tokenize_counts(spark, d):
    docs = t.documents(spark, d)
    return docs.select(
        "doc_id",
        F.size(txt.tokenize(F.col("text"))).alias("pieces"),
        txt.relevant_pieces(F.col("text"), t.TOKEN_CLASS).alias("relevant"),
        txt.token_count(F.col("text"), t.TOKEN_CLASS).alias("tokens"),
        F.length(F.array_join(txt.tokenize(F.col("text")), "")).alias("chars"),
    )


@query
def token_rows(spark, d):
    rows = ms.token_rows(ms.prepare_texts(t.corpus_files(spark, d)), t.TOKEN_CLASS)
    return rows.groupBy("piece", "relevant").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))


def _cut(spark, d):
    return ms.assign_milestones(ms.prepare_texts(t.corpus_files(spark, d)), t.MS_LEN, t.TOKEN_CLASS)


@query
def assign_milestones(spark, d):
    cut = exploded(_cut(spark, d), ["file_name"], "milestones", "i", "text")
    return cut.select(
        "file_name", (F.col("i") + 1).cast("bigint").alias("n"), "text",
        txt.relevant_pieces(F.col("text"), t.TOKEN_CLASS).alias("relevant"),
    )


@query
def range_milestones(spark, d):
    """The milestones of `assign_milestones`, from ranges of 400 characters."""
    ranges = rg.text_ranges(ms.prepare_texts(t.corpus_files(spark, d)), 400)
    texts = rg.milestone_texts(rg.cut_ranges(ranges, t.MS_LEN, t.TOKEN_CLASS))
    return texts.select("file_name", "n", "text", txt.relevant_pieces(F.col("text"), t.TOKEN_CLASS).alias("relevant"))


@query
def milestones_default(spark, d):
    """Default length and token class over texts whose letters are Arabic ones, vowel marks and tatweel among them."""
    arabic = F.translate("text", "aeiounsrtdlhmcbgpvyw", "إيءىأؤئآلدلهمكبـغَُِ")
    cut = t.documents(spark, d).select("doc_id", txt.cut_milestones(arabic).alias("milestones"))
    return exploded(cut, ["doc_id"], "milestones", "i", "text").select("doc_id", (F.col("i") + 1).cast("bigint").alias("n"), "text")


@query
def milestone_labels(spark, d):
    return ms.milestone_rows(ms.continue_numbering(_cut(spark, d))).select(
        "file_name", F.col("n").cast("bigint").alias("n"), "ms_label"
    )


@query
def continue_numbering(spark, d):
    numbered = ms.continue_numbering(_cut(spark, d))
    return numbered.select("file_name", "start", F.size("milestones").alias("n_ms"))


@query
def rebuild_text(spark, d):
    return ms.rebuild_text(ms.continue_numbering(_cut(spark, d))).select("file_name", "tagged")


@query
def milestoned_files(spark, d):
    checked = prepare.milestone_texts(t.corpus_files(spark, d), t.MS_LEN, t.TOKEN_CLASS)
    return ms.milestoned_files(ms.split_rejects(checked)[0])


@query
def milestone_checks(spark, d):
    """German documents carry tags that leave others behind when they are removed."""
    body = F.when(F.col("lang") == "de", t.overlapping_tags(F.col("text"))).otherwise(F.col("text"))
    checked = prepare.milestone_texts(t.corpus_files(spark, d, body), t.MS_LEN, t.TOKEN_CLASS)
    return ms.split_rejects(checked)[1]


# --- records ----------------------------------------------------------------------------


def _tagged(spark, d):
    return ms.rebuild_text(ms.continue_numbering(_cut(spark, d)))


@query
def explode_milestones(spark, d):
    return rec.explode_milestones(_tagged(spark, d).select("file_name", "tagged"), body="tagged").select(
        "file_name", F.col("pos").cast("bigint").alias("pos"), "ms_label", "text"
    )


@query
def record_text_clean(spark, d):
    """Some Latin letters are first turned into the Arabic ones the normaliser unifies."""
    arabic = F.translate("text", "aeiounsrt", "إيءىأؤئآل")
    return t.documents(spark, d).select("doc_id", txt.clean_text(arabic).alias("text"))


@query
def record_text_folded(spark, d):
    """Some Latin letters are first turned into vowel marks, presentation forms, ligatures and Persian letters."""
    arabic = F.translate("text", "aeiounsrtdlhmcbgp", "َّـﻻﷲﺑیکھۀےﺆًﭘچ\u200cﺖ")
    return t.documents(spark, d).select("doc_id", txt.clean_text(letters.fold_letters(arabic)).alias("text"))


@query
def record_chunks(spark, d):
    records = rec.to_records(rec.explode_milestones(_tagged(spark, d).drop("body"), body="tagged"))
    return rec.with_chunk(records, 10).groupBy("series", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq_min"), F.max("seq").alias("seq_max")
    )


@query
def text_records(spark, d):
    """Files to records: primary filter, best version, parts merged, cut, normalised."""
    tagged = computed_once(_tagged(spark, d), {"value": t.file_value(F.col("tagged"))}).drop("body", "tagged")
    texts = prepare.select_texts(tagged, t.version_metadata(spark, d), CorpusConfig(), t.corpus_files(spark, d))
    return prepare.text_records(texts, CorpusConfig(include_book_uri=True)).drop("pos")


# --- alignments -------------------------------------------------------------------------

_KEY = ("uid1", "uid2", "b1", "b2")


@query
def align_clean(spark, d):
    return al.clean_alignments(t.raw_alignments(spark, d))


@query
def ch_match(spark, d):
    s1, s2 = F.col("s1"), F.col("s2")
    return t.alignments(spark, d).select(
        *_KEY, align.ch_match(s1, s2).alias("ch_match"), align.ch_match(s1, s2, False).alias("ch_match_spaces")
    )


@query
def ch_match_arrow(spark, d):
    s1, s2 = F.col("s1"), F.col("s2")
    return t.alignments(spark, d).select(*_KEY, align.ch_match(s1, s2, kernel="arrow").alias("ch_match"))


@query
def align_len(spark, d):
    return t.alignments(spark, d).select(*_KEY, align.align_len(F.col("s1")).alias("align_len"))


@query
def matches_percent(spark, d):
    pct = align.matches_percent(F.col("matches"), F.length("s1"))
    return t.alignments(spark, d).select(*_KEY, pct.alias("matches_percent"))


@query
def w_match(spark, d):
    return t.alignments(spark, d).select(*_KEY, align.w_match(F.col("s1"), F.col("s2")).alias("w_match"))


@query
def count_dashes(spark, d):
    return t.alignments(spark, d).select(*_KEY, *[align.count_dashes(F.col(f"s{s}")).alias(f"dashes{s}") for s in (1, 2)])


@query
def first_token_ascii(spark, d):
    return t.documents(spark, d).select(
        "doc_id", align.first_token(F.col("text")).alias("first_token"), align.ascii_only(F.col("text")).alias("ascii")
    )


@query
def word_positions(spark, d):
    s1, s2 = (align.newline_to_space(F.col(s)) for s in ("s1", "s2"))
    positions = align.word_positions(s1, s2, F.col("bw1"), F.col("seq1"))
    return t.alignments(spark, d).select(*_KEY, F.array_join(positions.cast("array<string>"), ",").alias("positions"))


@query
def char_positions(spark, d):
    keyed = t.alignments(spark, d).select(
        *_KEY, *[align.newline_to_space(F.col(s)).alias(s) for s in ("s1", "s2")],
        *[uri.short_id(F.col(f"series{s}")).alias(f"_T{s}") for s in (1, 2)],
        *[F.col(f"seq{s}").cast("bigint").alias(f"seq{s}") for s in (1, 2)],
    )
    placed = bs.join_offsets(keyed, t.records(spark, d))
    positions = align.char_positions(F.col("s1"), F.col("s2"), F.col("b1"), F.col("ch_offset1"))
    return placed.select(*_KEY, F.array_join(positions.cast("array<string>"), ",").alias("positions"))


@query
def alignment_stats(spark, d):
    return al.alignment_stats(t.alignments(spark, d))


@query
def flip(spark, d):
    return pw.flip(al.alignment_stats(t.alignments(spark, d)))


@query
def flip_recompute(spark, d):
    return pw.flip(al.alignment_stats(t.alignments(spark, d)), recompute=True).select(*_KEY, "w_match")


@query
def bidirectional(spark, d):
    return pw.bidirectional(al.alignment_stats(t.alignments(spark, d)))


@query
def bidirectional_again(spark, d):
    """Tables in both directions, mirrored once more."""
    return pw.bidirectional(pw.one_direction(bidirectional(spark, d)))


@query
def pairwise_table(spark, d):
    """Raw alignments to the two-directional pairwise table."""
    usable, _ = al.split_unequal(al.clean_alignments(t.raw_alignments(spark, d)))
    return pw.bidirectional(al.alignment_stats(usable))


@query
def pairwise_rows(spark, d):
    """The same table as the job deals it out for writing."""
    return pairwise.pairwise_rows(t.raw_alignments(spark, d), both_directions=True)


@query
def pair_counts(spark, d):
    return pw.pair_counts(t.alignments(spark, d))


# --- book pairs -------------------------------------------------------------------------


@query
def milestone_offsets(spark, d):
    return bs.milestone_offsets(t.records(spark, d))


@query
def milestone_offsets_exclusive(spark, d):
    return bs.milestone_offsets(t.records(spark, d), "exclusive")


def _compared(spark, d):
    return bs.compared(t.alignments(spark, d))


def _pairs(spark, d):
    pairs = t.alignments(spark, d).select(*[uri.short_id(F.col(f"series{s}")).alias(f"_T{s}") for s in (1, 2)])
    return pairs.distinct()


@query
def meta_sides(spark, d):
    meta = t.book_metadata(spark, d)
    return bs.meta_side(meta, 1).join(bs.meta_side(meta, 2), F.col("T1") == F.col("T2"))


@query
def meta_join(spark, d):
    return bs.join_metadata(_pairs(spark, d), t.book_metadata(spark, d))


@query
def offset_join(spark, d):
    keys = t.alignments(spark, d).select(
        *_KEY,
        *[uri.short_id(F.col(f"series{s}")).alias(f"_T{s}") for s in (1, 2)],
        *[F.col(f"seq{s}").cast("bigint").alias(f"seq{s}") for s in (1, 2)],
    )
    return bs.join_offsets(keys, t.records(spark, d))


@query
def lost_alignments(spark, d):
    """Records of labelled documents only: alignments with any other document are lost."""
    labels = t.table(spark, d, "labels").select((F.col("doc_id") + 1).alias("seq"))
    known = t.records(spark, d).join(labels, "seq", "left_semi")
    keys = t.alignments(spark, d).select(
        *_KEY,
        *[uri.short_id(F.col(f"series{s}")).alias(f"_T{s}") for s in (1, 2)],
        *[F.col(f"seq{s}").cast("bigint").alias(f"seq{s}") for s in (1, 2)],
    )
    return bs.lost_alignments(keys, known)


@query
def duplicate_milestones(spark, d):
    """Milestones numbered by length of text: books share some numbers."""
    return bs.duplicate_milestones(t.records(spark, d).withColumn("seq", F.length("text")))


@query
def wm_totals(spark, d):
    return bs.matched_totals(_compared(spark, d)).select("_T1", "_T2", "WM1_Total", "WM2_Total")


@query
def cm_totals(spark, d):
    joined = bs.join_offsets(_compared(spark, d), t.records(spark, d))
    return bs.matched_totals(joined).select("_T1", "_T2", "CM1_Total", "CM2_Total")


@query
def matches_summary(spark, d):
    return bs.matched_totals(_compared(spark, d)).select(
        "_T1", "_T2", "instances", "ch_MATCHES_Min", "ch_MATCHES_Max", "ch_MATCHES_Mean"
    )


@query
def positions_len_stats(spark, d):
    return bs.positions_len_stats(_compared(spark, d))


@query
def ratios(spark, d):
    return book_pair_stats(spark, d).select("_T1", "_T2", "WM_B2inB1", "WM_B1inB2", "CM_B2inB1", "CM_B1inB2")


@query
def chrono(spark, d):
    pairs = bs.join_metadata(_pairs(spark, d), t.book_metadata(spark, d))
    return bs.with_chrono(pairs).select("_T1", "_T2", "chrono_B1B2", "chrono_B2B1")


@query
def book_pair_stats(spark, d):
    return bs.book_pair_stats(t.alignments(spark, d), t.records(spark, d), t.book_metadata(spark, d))
