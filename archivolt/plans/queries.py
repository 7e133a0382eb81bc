"""The core queries: one function (spark, folder) -> DataFrame per name, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions import similarity, text
from archivolt.functions.dates import parse_date, sent_date
from archivolt.functions.fingerprints import with_fingerprints
from archivolt.operators import conversations as conv
from archivolt.operators import graph, joins, links, render, search, threads, timestamps
from archivolt.runtime import materialize, spread, table
from archivolt.sources import crawl
from archivolt.streaming.scan import hits_by_day as stream_hits_by_day

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _col(name: str):
    return F.col(name)


# keyword search


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return search.keyword_hits(search.to_pages(spread(table(spark, d, "documents").select("folder", "filename", "text"))), search.load_keywords(table(spark, d, "keywords")))


def _listing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("folder", "filename")


@query
def keyword_load(spark: SparkSession, d: str) -> DataFrame:
    return search.load_keywords(table(spark, d, "keywords"))


@query
def fold_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.fold(_col("text")).alias("folded"))


@query
def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d).groupBy("folder", "filename", "page", "ord", "keyword").agg(F.count("*").alias("n"))


@query
def keyword_context(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d).select("folder", "filename", "page", "ord", "keyword", "start", "context")


@query
def hits_by_keyword(spark: SparkSession, d: str) -> DataFrame:
    return search.hits_by(_hits(spark, d), "keyword")


@query
def hits_by_folder(spark: SparkSession, d: str) -> DataFrame:
    return search.hits_by(_hits(spark, d), "folder")


@query
def hits_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return search.hits_breakdown(_hits(spark, d))


@query
def file_keywords(spark: SparkSession, d: str) -> DataFrame:
    return search.file_keywords(_hits(spark, d))


@query
def scan_totals(spark: SparkSession, d: str) -> DataFrame:
    return search.scan_totals(_hits(spark, d), _listing(spark, d))


@query
def matched_files(spark: SparkSession, d: str) -> DataFrame:
    return search.matched_files(table(spark, d, "search_results"), _listing(spark, d))


@query
def result_file_keywords(spark: SparkSession, d: str) -> DataFrame:
    return search.file_keywords(table(spark, d, "search_results").where("keyword is not null"))


@query
def summary_rows(spark: SparkSession, d: str) -> DataFrame:
    return search.summary_rows(table(spark, d, "search_results").where("keyword is not null"))


@query
def recent_matches_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.recent_matches(table(spark, d, "search_results").select("hit_id", "filename", "keyword", "found_at"), [_col("found_at"), _col("hit_id")])


@query
def file_id_semijoin(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "search_results").select("filename").distinct().join(_listing(spark, d).select("filename"), "filename", "left_semi")


@query
def needs_ocr(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").select("filename", F.split("text", "\n\n").alias("pages"))
    return search.needs_ocr(pages, per_page=180).select("filename", F.size("pages").alias("n_pages"), "needs_ocr")


@query
def hits_by_day(spark: SparkSession, d: str) -> DataFrame:
    return stream_hits_by_day(table(spark, d, "search_results"))


# stored crawl pages


@query
def html_link_extract(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "crawl_results")
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    number = F.regexp_extract("folder", r"(\d+)", 1)
    heading = F.concat(F.lit('<div class="result-item"><h3><a href="'), F.col("pdf_url"), F.lit('">'), F.col("filename"), F.lit("</a> - "), F.when(number != "", F.concat(F.lit("DataSet "), number)).otherwise("Loose"), F.lit('</h3><p class="result-excerpt">'), esc(F.col("context")), F.lit("</p></div>"))
    return crawl.crawl_hits(hits.select("keyword", "page", heading.alias("html"))).select("folder", "keyword", "filename", "page", "context", "pdf_url").distinct()


@query
def folder_from_heading(spark: SparkSession, d: str) -> DataFrame:
    heading = F.concat(F.col("filename"), F.lit(" - DataSet "), F.regexp_replace("folder", "^DS-", ""))
    return table(spark, d, "crawl_results").select("filename", heading.alias("heading")).distinct().select("filename", "heading", crawl.folder_of_heading(F.col("heading")).alias("folder"))


@query
def pagination_math(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "crawl_results").where("keyword is not null").groupBy("keyword").agg(F.count("*").alias("n"))
    label = F.when(F.col("n") % 5 > 0, F.concat(F.lit("Showing 1 to "), (F.col("n") % 7 + 4).cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" Results"))).otherwise("")
    results, pages = crawl.result_counts(F.col("label"), F.col("n"))
    return seen.withColumn("label", label).select("keyword", "label", results.alias("results"), pages.alias("pages"))


@query
def pdf_magic_filter(spark: SparkSession, d: str) -> DataFrame:
    head = F.when(F.col("doc_id") % 3 == 0, "<html>").otherwise("%PDF-1.7 ")
    url = F.concat(F.lit("data:application/pdf;base64,"), F.base64(F.concat(head, F.col("filename")).cast("binary")))
    data = table(spark, d, "documents").select("filename", crawl.pdf_bytes(url).alias("data"))
    return data.where("data is not null").select("filename", F.octet_length("data").alias("n_bytes"))


@query
def crawl_dedup(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "crawl_results").select("keyword", "filename", "page", "folder", "pdf_url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"))
    return crawl.crawl_dedup(hits, ["page", "folder", "pdf_url", "fetched"])


@query
def download_plan(spark: SparkSession, d: str) -> DataFrame:
    return crawl.download_plan(table(spark, d, "crawl_results"), table(spark, d, "documents").where("page_count = 1"))


@query
def download_counts(spark: SparkSession, d: str) -> DataFrame:
    plan = download_plan(spark, d).withColumn("status", F.when(F.col("status") == "wanted", F.when(F.length("pdf_url") > 0, "downloaded").otherwise("failed")).otherwise("skipped"))
    return crawl.download_counts(plan)


@query
def crawl_page_totals(spark: SparkSession, d: str) -> DataFrame:
    return crawl.keyword_page_totals(table(spark, d, "crawl_results"))


# text functions


@query
def extract_emails(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(text.extract_emails(F.col("text")), " ").alias("emails"))


@query
def normalize_email(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("sender").distinct().select("sender", text.normalize_email(F.col("sender")).alias("normal"))


@query
def extract_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(text.extract_names(F.col("text"), ("William Keldiford", "Legal Services")), "|").alias("found"))


@query
def header_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", *(v.alias(f"h_{k}") for k, v in text.headers(F.col("text")).items()))


@query
def doc_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.document_type(F.col("text")).alias("found_type"))


@query
def doc_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return doc_type(spark, d).groupBy("found_type").agg(F.count("*").alias("n")).orderBy("found_type")


@query
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query
def clean_message_body(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("msg_id", text.clean_message_body(F.col("body")).alias("cleaned")).distinct()


@query
def clean_for_matching(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.clean_for_matching(F.col("text")).alias("cleaned"))


@query
def fix_date_ocr(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("date_str").distinct().select("date_str", text.fix_date_ocr(F.col("date_str")).alias("fixed"))


@query
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("date_str").distinct().select("date_str", F.date_format(parse_date(F.col("date_str")), "yyyy-MM-dd HH:mm:ss").alias("wall"))


@query
def normalize_body(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("msg_id", text.normalize_body(F.col("body")).alias("norm")).distinct()


@query
def subject_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("subject").distinct().select("subject", text.subject_norm(F.col("subject")).alias("norm"))


@query
def format_time(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.duration(F.col("n_chars") * 4).alias("shown"))


@query
def clean_participant(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "messages").select("sender").distinct().select("sender", text.clean_participant(F.col("sender")).alias("cleaned"))


@query
def render_dates(spark: SparkSession, d: str) -> DataFrame:
    when = F.col("date_ts")
    return table(spark, d, "messages").where("date_ts is not null").select("msg_id", F.date_format(when, "MMMM dd, yyyy").alias("day"), F.date_format(when, "MMMM dd, yyyy 'at' hh:mm a").alias("moment")).distinct()


# messages of threads


@query
def quote_boundary(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return threads.with_quote_boundary(pages, "text").drop("text")


@query
def thread_messages(spark: SparkSession, d: str) -> DataFrame:
    kept = threads.messages(spread(table(spark, d, "documents").where("doc_type = 'email'").select("filename", "text")))
    return kept.select("filename", "msg_idx", "sender", "recipient", "date_str", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("wall"), "subject", "body")


@query
def thread_participants(spark: SparkSession, d: str) -> DataFrame:
    return threads.participants(threads.messages(table(spark, d, "documents").where("doc_type = 'email'"), parse_dates=False))


@query
def main_body(spark: SparkSession, d: str) -> DataFrame:
    """What stands above the quote boundary of every document."""
    return threads.messages(table(spark, d, "documents"), parse_dates=False).where("msg_idx = 0").select("filename", "body")


@query
def quoted_message(spark: SparkSession, d: str) -> DataFrame:
    """The first quoted message of every document that holds one."""
    return threads.messages(table(spark, d, "documents"), parse_dates=False).where("msg_idx = 1").select("filename", "sender", "recipient", "date_str", "subject", "body")


@query
def name_occurrences(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents")
    return threads.name_occurrences(pages.select("filename", text.extract_emails(F.col("text")).alias("email_addresses"), text.extract_names(F.col("text")).alias("names")))


@query
def name_email_pairs(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents")
    found = pages.select("filename", text.extract_emails(F.col("text")).alias("email_addresses"), text.extract_names(F.col("text")).alias("names"))
    return threads.name_email_pairs(found)


# joins


@query
def ordinal_band_join(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select("filename", text.file_ordinal(F.col("filename")).alias("n")).where("n is not null")
    pairs = joins.band_join(files.select(F.col("filename").alias("i"), F.col("n").alias("a")), files.select(F.col("filename").alias("j"), F.col("n").alias("b")), "a", "b", 50)
    return pairs.where("i < j").groupBy("i").agg(F.count("*").alias("n_close"), F.max("j").alias("last_close"))


@query
def same_date_interval_join(spark: SparkSession, d: str) -> DataFrame:
    mail = table(spark, d, "messages").where("date_ts is not null").select("folder", "msg_id", "date_ts").distinct()
    days = table(spark, d, "messages").where("date_ts is not null").groupBy("folder").agg(F.min("date_ts").alias("first_ts"), F.max("date_ts").alias("last_ts"))
    edges = days.select("folder", F.explode(F.array("first_ts", "last_ts")).alias("edge_ts"))
    near = joins.day_after_join(mail.select("msg_id", F.col("date_ts").alias("a")), edges.select(F.col("folder").alias("edge_folder"), F.col("edge_ts").alias("b")), "a", "b")
    return near.groupBy("edge_folder").agg(F.count("*").alias("n_within_day"))


@query
def same_date_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many other messages stand at or less than 24 hours before each dated message."""
    mail = table(spark, d, "messages").where("date_ts is not null").select("folder", "msg_id", "date_ts").distinct()
    side = lambda k, c: mail.select(F.struct("folder", "msg_id", "date_ts").alias(k), F.col("date_ts").alias(c))
    near = joins.day_after_join(side("i", "a"), side("j", "b"), "a", "b").where("i <> j")
    return near.groupBy("i").agg(F.count("*").alias("n_within_day")).select("i.folder", "i.msg_id", "i.date_ts", "n_within_day")


@query
def shared_email_overlap(spark: SparkSession, d: str) -> DataFrame:
    """How many of a document's addresses other documents hold too."""
    each = table(spark, d, "documents").select("doc_id", F.explode(text.extract_emails(F.col("text"))).alias("email"))
    common = each.groupBy("email").agg(F.count("*").alias("n")).where("n > 1").select("email")
    return each.join(common, "email").groupBy("doc_id").agg(F.count("*").alias("n_shared"))


@query
def chunk_shingles(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").select("doc_id", text.clean_for_matching(F.col("text")).alias("clean"))
    return pages.select("doc_id", F.size(joins.text_chunks(F.col("clean"))).alias("n_chunks"))


@query
def subject_similarity(spark: SparkSession, d: str) -> DataFrame:
    subjects = table(spark, d, "messages").select(F.lower(text.subject_norm(F.col("subject"))).alias("s")).where("length(s) > 3")
    return joins.fuzzy_pairs(subjects, "s", 80)


@query
def indel_ratio(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "messages").select("subject", "sender").distinct()
    return pairs.select("subject", "sender", F.round(similarity.indel_ratio("subject", "sender"), 6).alias("ratio"))


# links, clusters, conversations


def _linked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    documents = spread(table(spark, d, "documents").select("filename", "text"))
    features = materialize(threads.document_features(documents), "features")
    kept = materialize(threads.messages(features.where("doc_type = 'email'").select("filename", "text")).drop("raw_text"), "messages")
    return features, kept, links.link_features(features, kept.select("filename", "date"))


@query
def quoted_text_match(spark: SparkSession, d: str) -> DataFrame:
    docs = materialize(with_fingerprints(table(spark, d, "documents").select("filename", text.clean_for_matching(F.col("text")).alias("clean")), "clean"), "printed")
    found = joins.quoted_pairs(docs, "filename", "clean", joins.text_chunks(F.col("clean")))
    return found.select(F.explode(F.array("i", "j")).alias("filename")).groupBy("filename").agg(F.count("*").alias("n_links"))


@query
def link_confidence(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(0, 175, 5).select(F.col("id").alias("score"), links.confidence(F.col("id")).alias("confidence"))


@query
def link_edges(spark: SparkSession, d: str) -> DataFrame:
    return links.link_edges(_linked(spark, d)[2])


@query
def doc_components(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "documents").select("filename", F.lower(text.subject_norm(F.col("subject"))).alias("s")).where("length(s) > 3")
    return graph.connected_components(joins.group_pairs(named, "s", "filename", joins.HOT_GROUP), "i", "j")


@query
def capped_clusters(spark: SparkSession, d: str) -> DataFrame:
    return graph.capped_clusters(links.link_edges(_linked(spark, d)[2]))


@query
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    mail = table(spark, d, "messages").select("msg_id", "folder", "body")
    return conv.dedup_exact(mail, "folder", ["msg_id"]).select("folder", "msg_id").distinct()


@query
def dedup_messages(spark: SparkSession, d: str) -> DataFrame:
    # a message that was delivered again is an exact copy, which goes anyway
    mail = spread(table(spark, d, "messages").select("msg_id", "subject", "body")).select("msg_id", text.subject_norm(F.col("subject")).alias("thread"), "body")
    return conv.dedup_messages(mail, "thread", ["msg_id"], keep=["msg_id"]).select("thread", "msg_id")


@query
def message_numbering(spark: SparkSession, d: str) -> DataFrame:
    mail = table(spark, d, "messages").select("msg_id", "source_file", F.col("date_ts").alias("date")).distinct()
    return conv.sort_messages(mail, "source_file", ["msg_id"]).select("source_file", "number", "msg_id")


@query
def sort_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages of a file in order of time; a missing date is read from the date text."""
    mail = table(spark, d, "messages").select("msg_id", "source_file", "date_ts", "date_str").distinct()
    dated = mail.withColumn("date", sent_date(F.col("date_ts").cast("timestamp_ntz"), F.col("date_str")))
    return conv.sort_messages(dated, "source_file", ["msg_id"]).select("source_file", "number", "msg_id", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("wall"))


@query
def dedup_containment(spark: SparkSession, d: str) -> DataFrame:
    """How many other messages of its subject hold a message as a part."""
    mail = table(spark, d, "messages").select("msg_id", text.subject_norm(F.col("subject")).alias("thread"), "body").where("thread is not null").distinct()
    first = materialize(conv.dedup_exact(mail, "thread", ["msg_id"]).select("thread", "norm", "msg_id"), "bodies")
    held = conv.contained_pairs(first, "thread").groupBy("thread", F.col("a").alias("norm")).agg(F.count("*").alias("n_holders"))
    return first.join(held, ["thread", "norm"]).select("thread", "msg_id", "n_holders")


@query
def conversation_subject(spark: SparkSession, d: str) -> DataFrame:
    return conv.conversation_subject(table(spark, d, "messages").select("msg_id", "source_file", "subject").distinct(), "source_file")


@query
def conversation_date_range(spark: SparkSession, d: str) -> DataFrame:
    mail = table(spark, d, "messages").select("source_file", F.col("date_ts").alias("date"))
    return conv.conversation_date_range(mail, "source_file")


@query
def conversation_participants(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "messages").select("source_file", F.explode(F.array("sender", "recipient")).alias("participant"))
    return conv.conversation_participants(people, "source_file").select("source_file", F.array_join("participants", "|").alias("participants"))


@query
def participant_collapse(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "messages").select("source_file", F.explode(F.array("sender", "recipient")).alias("participant"))
    return conv.participant_collapse(people, "source_file")


@query
def conversation_numbering(spark: SparkSession, d: str) -> DataFrame:
    ranges = conversation_date_range(spark, d)
    return conv.numbered(ranges, [F.col("date_min").asc_nulls_last(), F.col("source_file").asc()]).select("id", "source_file")


def _alone(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """The documents in no conversation."""
    return features.join(clusters.where("size > 1").select(F.col("node").alias("filename")), "filename", "left_anti")


def _conversations(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    features, kept, docs = _linked(spark, d)
    docs = materialize(docs, "linkdocs")
    quoted, alike = links.common_text(docs), links.like_subjects(docs)
    clusters = materialize(graph.capped_clusters(links.link_edges(docs, found=(quoted, alike))), "clusters")
    scored = links.score_pairs(conv.cluster_pairs(clusters), docs, quoted, alike)
    talks, mail = conv.conversations(clusters, features, kept, scored)
    return materialize(talks, "talks"), mail, _alone(features, clusters)


@query
def conversation_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _conversations(spark, d)[0].select("id", "cluster", F.size("documents").alias("n_documents"), "subject", "n_messages", "mean_score", "confidence")


@query
def conversation_markdown(spark: SparkSession, d: str) -> DataFrame:
    talks, mail, _ = _conversations(spark, d)
    return render.conversation_markdown(talks, mail)


@query
def standalone_markdown(spark: SparkSession, d: str) -> DataFrame:
    features, kept, docs = _linked(spark, d)
    alone = _alone(features, materialize(graph.capped_clusters(links.link_edges(docs)), "clusters"))
    ready = conv.numbered(alone.withColumn("content", text.clean_text(F.col("text"))), [F.col("filename").asc()])
    return render.standalone_markdown(ready, kept)


@query
def index_lines(spark: SparkSession, d: str) -> DataFrame:
    talks, _, alone = _conversations(spark, d)
    return render.index_lines(talks, conv.numbered(alone.select("filename"), [F.col("filename").asc()]))


@query
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    """Index rows of the messages' own files, each taken for a conversation."""
    parts = table(spark, d, "messages").groupBy("source_file").agg(F.min("date_ts").alias("date_min"), F.max("date_ts").alias("date_max"), F.min("subject").alias("subject"), F.collect_set("folder").alias("documents"), F.collect_set("sender").alias("participants"))
    ready = parts.withColumn("id", text.file_ordinal(F.col("source_file"))).withColumn("confidence", links.confidence(F.size("participants") * 30))
    return render.index_rows(ready)


# time


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    out = timestamps.normalise_timestamps(table(spark, d, "messages"), table(spark, d, "folders"))
    return out.where("instant_utc is not null").select("msg_id", "instant_utc")


@query
def p4_basis_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many messages each kind of zone evidence decides."""
    out = timestamps.normalise_timestamps(table(spark, d, "messages"), table(spark, d, "folders"))
    return out.groupBy("basis").agg(F.count("*").alias("n"))


@query
def p4_zones(spark: SparkSession, d: str) -> DataFrame:
    """Per folder the zone taken, and the zone that the order of events favours."""
    return timestamps.zone_report(table(spark, d, "messages"), table(spark, d, "folders"))
