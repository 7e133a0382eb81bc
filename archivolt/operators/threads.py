"""Mail threads from raw text: the main message and the first quoted one.

All steps are column expressions. A document gives at most two messages, in
this order: what stands above the quote boundary, and what is quoted there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.dates import parse_date
from archivolt.functions.text import clean_text, document_type, extract_emails, extract_names, headers, once, strip

# What opens a quoted message, with its date, name and address, and what opens one without them.
ATTRIBUTION = r"(?dimuU)On\s+([\w,\s]+\d{4}[,\s]+(?:at\s+)?\d{1,2}:\d{2}\s*(?:AM|PM)?)[,\s]*([^<\n]*)?(?:<([^>]+)>)?\s*(?:>?\s*wrote:)?"
MARKERS = (r"-{3,}\s*Original message\s*-{3,}", r"----+\s*Original message", r"Sent using BlackBerry", r"Sent from my iPhone", r"Sent from my iPod")
_HEADER_BLOCK = r"(?diuU)\A(?:[^\S\n]*(?:(?:to|from|sent|date|subject|fran):[^\n]*)?(?:\n|\z))*[^\S\n]*(?:to|from|sent|date|subject|fran):[^\n]*(?:\n|\z)"


def _first_offset(text: Column, pattern: str) -> Column:
    """Characters before the first match, null without one (``split`` counts code points, unlike the regexp offsets)."""
    head = F.split(text, pattern, 2)
    return F.when(F.size(head) > 1, F.length(head[0]))


def with_quote_boundary(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the ``offset`` of the first quote (the text's length without one) and ``attributed``: whether it names date and sender.

    The offsets are one stage and their comparison the next, so no pattern runs twice over a text.
    """
    marked = once(F.lower(text), lambda low: F.contains(low, F.lit("---")) | F.contains(low, F.lit("ent from")) | F.contains(low, F.lit("ent using")))
    plain = F.when(marked, F.least(*(_first_offset(F.col(text), "(?diuU)" + m) for m in MARKERS), F.length(text))).otherwise(F.length(text))
    found = df.select("*", _first_offset(F.col(text), ATTRIBUTION).alias("_named"), plain.alias("_plain"))
    return found.select(*df.columns, F.least("_named", "_plain").alias("offset"), F.coalesce((F.col("_named") <= F.col("_plain")) & (F.col("_named") < F.length(text)), F.lit(False)).alias("attributed"))


def main_body(above: Column) -> Column:
    """The text above the boundary without its leading block of header lines, junk removed."""
    return clean_text(strip(F.regexp_replace(strip(above), _HEADER_BLOCK, "")))


def quoted_parts(quoted: Column, attributed: Column) -> dict[str, Column]:
    """``sender, date_str, body`` of the text from the boundary on."""
    take = lambda g: F.when(attributed, strip(F.regexp_extract(quoted, ATTRIBUTION, g))).otherwise("")
    name = F.regexp_replace(take(2), r",+$", "")
    name = strip(F.regexp_replace(strip(F.regexp_replace(name, r"(?iuU)\s*>?\s*wrote:?\s*$", "")), r">+$", ""))
    address = take(3)
    sender = F.when((address != "") & (name != ""), F.concat(F.lit('"'), name, F.lit('" <'), address, F.lit(">"))).otherwise(F.when(address != "", address).otherwise(name))
    after = F.split(quoted, r"(?iuU)wrote:\s*", 2)
    line = F.split(quoted, r"(?dU)On\s+[^\n]+\n", 2)
    body = F.when(F.size(after) > 1, after[1]).when(F.size(line) > 1, line[1]).otherwise(quoted)
    body = F.regexp_replace(strip(body), r"(?dmU)^>\s?", "")
    body = F.split(body, r"(?U)\n\s*On\s+[\w,\s]+\d{4}", 2)[0]
    for signature in (r"(?siuU)\n--\s*\n.*", r"(?siuU)\nSent from my.*", r"(?siuU)\n_{3,}.*"):
        body = F.regexp_replace(body, signature, "")
    return {"sender": sender, "date_str": take(1), "body": clean_text(body)}


def messages(documents: DataFrame, text: str = "text", parse_dates: bool = True) -> DataFrame:
    """``filename, msg_idx, sender, recipient, date, date_str, subject, body, source_file, raw_text`` of each kept message.

    The main message is kept if its body has more than 5 characters, the quoted one if more than 10.
    Null texts give no message.
    """
    one = with_quote_boundary(documents.where(F.col(text).isNotNull()).select("filename", F.col(text).alias("_t")), "_t")
    one = one.select("filename", "_t", F.col("offset").alias("_offset"), F.col("attributed").alias("_attributed"), *(v.alias(f"_{k}") for k, v in headers(F.col("_t")).items()))
    two = one.select("*", strip(F.substring("_t", F.lit(1), F.col("_offset"))).alias("_above"), F.when(F.col("_offset") < F.length("_t"), strip(F.substring(F.col("_t"), F.col("_offset") + 1, F.length("_t")))).alias("_quoted"))
    quoted = quoted_parts(F.col("_quoted"), F.col("_attributed"))
    three = two.select("*", main_body(F.col("_above")).alias("_body"), *(v.alias(f"_q_{k}") for k, v in quoted.items()))
    main = F.struct(F.lit(0).alias("msg_idx"), F.col("_from").alias("sender"), F.col("_to").alias("recipient"), F.col("_sent").alias("date_str"), F.col("_subject").alias("subject"), F.col("_body").alias("body"), F.col("_above").alias("raw_text"))
    reply = F.struct(F.lit(1).alias("msg_idx"), F.col("_q_sender").alias("sender"), F.col("_from").alias("recipient"), F.col("_q_date_str").alias("date_str"), F.col("_subject").alias("subject"), F.col("_q_body").alias("body"), F.substring("_quoted", 1, 500).alias("raw_text"))
    both = three.select("filename", F.array(F.when(F.length("_body") > 5, main), F.when(F.length("_q_body") > 10, reply)).alias("_both"))
    out = both.select("filename", F.explode(F.filter("_both", lambda m: m.isNotNull())).alias("m")).select("filename", "m.*").withColumn("source_file", F.col("filename"))
    return out.withColumn("date", parse_date(F.col("date_str"))) if parse_dates else out


def document_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """Type, addresses, names and subject of every document with text.

    Documents are ordered by ``filename`` wherever order matters, so no running number is dealt out.
    """
    real = documents.where(strip(F.col(text)) != "")
    return real.select("filename", F.col(text).alias("text"), document_type(F.col(text)).alias("doc_type"), extract_emails(F.col(text)).alias("email_addresses"), extract_names(F.col(text)).alias("names"), headers(F.col(text))["subject"].alias("subject"))


def participants(kept: DataFrame) -> DataFrame:
    """``filename, participant``: the non-empty senders and recipients of kept messages, each once."""
    return kept.select("filename", F.explode(F.array("sender", "recipient")).alias("participant")).where("participant <> ''").distinct()


def name_email_pairs(features: DataFrame) -> DataFrame:
    """``email, name, n_documents``: names and addresses that occur in the same document."""
    pairs = features.select("filename", F.explode("email_addresses").alias("email"), "names").select("filename", F.lower("email").alias("email"), F.explode("names").alias("name"))
    return pairs.groupBy("email", "name").agg(F.count_distinct("filename").alias("n_documents"))


def name_occurrences(features: DataFrame) -> DataFrame:
    """``name, filename, times``: where a name stands beside an address, once for each address of the document."""
    each = features.select("filename", F.explode("names").alias("name"), F.size("email_addresses").alias("times"))
    return each.where("times > 0").groupBy("name", "filename").agg(F.sum("times").alias("times"))
