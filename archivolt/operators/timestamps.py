"""Mixed timestamp notations and zones to UTC instants.

``normalise_timestamps`` reads a free-form time text with built-in string
functions only, so the whole operator stays in generated JVM code. A zone or
offset written in the text counts. Without one the text is a wall clock whose
zone ``estimate_zones`` supplies per group (here: folder). For every candidate zone (an IANA
offset history) it counts violations: messages that would be sent after they were ingested, and replies that would be sent
before the message they answer. A declared zone is binding; groups without a
usable declaration take the zone with the fewest violations, of equals the one that
agrees with most zones written in the group's own messages.

Defined results: a null, empty, unreadable or date-only text gives a null
instant; a repeated hour the earlier instant; a skipped hour the instant
reckoned with the offset valid before the change; two-digit years are 20xx;
missing seconds are 0 and fractions are dropped. Repeated rows of one key count
once (the smallest text wins if copies differ).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.runtime import materialize

# Month names as they start in English, French and German, folded to lower case.
MONTHS = {
    1: ("jan",), 2: ("feb", "fév", "fev"), 3: ("mar", "mär", "mrz"), 4: ("apr", "avr"), 5: ("may", "mai"),
    6: ("jun", "juin"), 7: ("jul", "juil"), 8: ("aug", "aoû", "aou"), 9: ("sep",), 10: ("oct", "okt"),
    11: ("nov",), 12: ("dec", "déc", "dez"),
}
# Zone abbreviations in mail headers and their offsets.
ABBREVIATIONS = {
    "UTC": "+00:00", "GMT": "+00:00", "UT": "+00:00", "Z": "+00:00", "WET": "+00:00", "WEST": "+01:00",
    "BST": "+01:00", "CET": "+01:00", "CEST": "+02:00", "MEZ": "+01:00", "MESZ": "+02:00", "EET": "+02:00",
    "EEST": "+03:00", "MSK": "+03:00", "GST": "+04:00", "IST": "+05:30", "AEST": "+10:00", "AEDT": "+11:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00",
}

_MONTH_WORD = "(?iu)\\b(" + "|".join(sorted({w for ws in MONTHS.values() for w in ws}, key=lambda w: (-len(w), w))) + ")\\p{L}*\\.?"


def _part(text: Column | str, pattern: str, group: int) -> Column:
    """A capture group, null where it is absent."""
    return F.nullif(F.regexp_extract(F.col(text) if isinstance(text, str) else text, pattern, group), F.lit(""))


# Look-alikes of digits: pairs of a letter class and the digit it stands for.
_LOOK_ALIKES = (("[Oo]", "0"), ("[Il|]", "1"), ("S", "5"), ("B", "8"))


def repair_digits(text: Column) -> Column:
    """Letters misread for digits, and stray blanks or semicolons in clock times, set right.

    A letter counts as a digit only in a token of digits and look-alikes that
    follows a blank, a digit or punctuation and holds a digit, or that stands
    before a comma or colon. Names of months, days and zones hold other letters.
    """
    t = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    t = F.regexp_replace(t, r"(?<=[\dOIl]) ?[;:] ?(?=[\dOIl])", ":")
    token = r"(?<![A-Za-z])(?=[OoIl|SB\d]+(?:[,:./ -]|$))(?:(?=[OoIl|SB]*\d|[OoIl]{1,2}[,:])|(?<=\d:)(?=[OoIl]{2}(?: |$)))"
    # one to four letters of a token in turn: the lookahead keeps to tokens without other letters
    for bad, digit in _LOOK_ALIKES:
        for done in range(4):
            t = F.regexp_replace(t, token + rf"([OoIl|SB\d]{{{done}}}){bad}", f"$1{digit}")
    return t


def parse_timestamp(df: DataFrame, text: str = "date_str", day_first: str = "day_first") -> DataFrame:
    """``df`` with ``wall`` (timestamp_ntz), ``offset`` (``+hh:mm``), ``region`` (IANA name) and ``epoch`` (timestamp_ntz).

    The parts are taken in stages, so that each expression is evaluated once a row.
    """
    kept = [F.col(c) for c in df.columns]
    packed = r"(?:^|D:)(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})?(?=$|[Zz+\-.])"
    ymd = r"(?<!\d)(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
    abc = r"(?<![\d:])(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})(?![\d:])"
    clock = r"(?<![\d+\-:.])(\d{1,2}):(\d{2})(?::(\d{2}))?(?:[.,]\d+)?(?![\d:])(?: ?([AaPp])\.?[Mm]\b\.?)?"
    dotted = r"(?:^|[ T])(\d{1,2})\.(\d{2})(?:\.(\d{2}))?(?![\d.])(?: ?([AaPp])\.?[Mm]\b\.?)?"
    signed = r"(?:(?<=\d)|(?<=\d )|(?<=GMT)|(?<=UTC)|(?<=M ))([+\-])(\d{2}):?'?(\d{2})'?(?!\d)(?!-)"

    def joined(pattern: str, source: str, groups: tuple[int, ...]) -> Column:
        """The groups of the first match in one text, parted by blanks-free bars."""
        return F.concat_ws("|", *(F.regexp_extract(F.col(source), pattern, g) for g in groups))

    one = df.select(*kept, repair_digits(F.col(text)).alias("_t"))
    two = one.select(*kept, "_t", F.regexp_replace("_t", r"(?<=\d)T(?=\d\d?:)", " ").alias("_s"))
    three = two.select(
        *kept,
        "_t",
        "_s",
        F.regexp_replace("_s", r"\d{1,2}\.\d{1,2}\.(\d{4}|\d{2})", " ").alias("_n"),
        F.regexp_replace("_s", r"\d{1,2}:\d{2}(:\d{2})?([.,]\d+)?|[+\-]\d{2}:?\d{2}\b", " ").alias("_r"),
    )
    four = three.select(
        *kept,
        "_t",
        "_r",
        F.split(F.when(F.col("_t").rlike(packed), joined(packed, "_t", (1, 2, 3, 4, 5, 6))), "\\|").alias("_packed"),
        F.split(F.when(F.col("_t").rlike(ymd), joined(ymd, "_t", (1, 2, 3))), "\\|").alias("_ymd"),
        F.split(F.when(F.col("_t").rlike(abc), joined(abc, "_t", (1, 3, 4))), "\\|").alias("_abc"),
        F.split(F.when(F.col("_s").rlike(clock), joined(clock, "_s", (1, 2, 3, 4))).when(F.col("_n").rlike(dotted), joined(dotted, "_n", (1, 2, 3, 4))), "\\|").alias("_clock"),
        F.split(F.when(F.col("_t").rlike(signed), joined(signed, "_t", (1, 2, 3))), "\\|").alias("_signed"),
        F.lower(_part("_r", _MONTH_WORD, 1)).alias("_word"),
        F.trim(text).alias("_d"),
    )
    day_before = r"(?<!\d)(\d{1,2})(?:st|nd|rd|th|er)?\.?[ \-/]*(?:of |de )?" + _MONTH_WORD.replace("(?iu)\\b(", "(?iu)(?:")
    five = four.select(
        *kept,
        *("_t _packed _ymd _abc _clock _signed _d".split()),
        F.when(F.col("_word").isNotNull(), F.coalesce(*(F.when(F.col("_word").isin(*starts), F.lit(n)) for n, starts in MONTHS.items()))).alias("_month"),
        F.when(F.col("_word").isNotNull(), F.regexp_extract("_r", day_before, 1)).alias("_before"),
        F.when(F.col("_word").isNotNull(), F.regexp_extract("_r", _MONTH_WORD + r"[ \-/]*(\d{1,2})(?:st|nd|rd|th)?(?!\d)", 2)).alias("_after"),
        F.when(F.col("_word").isNotNull(), F.regexp_extract("_r", r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1)).alias("_year4"),
        F.when(F.col("_word").isNotNull(), F.regexp_extract("_r", _MONTH_WORD + r"[\-/ ]'?(\d{2})(?!\d)(?=[ T,]|$)", 2)).alias("_year2"),
        F.coalesce(F.col(day_first), F.lit(False)).alias("_first"),
    )
    at = lambda c, k: F.get(F.col(c), F.lit(k)).try_cast("int")
    a, b, c = at("_abc", 0), at("_abc", 1), at("_abc", 2)
    as_written = F.when(F.col("_first"), b).otherwise(a)
    # a month above 12 is impossible as this group writes dates, so the other order is meant
    month_second = F.col("_first") != (as_written > 12)
    named = F.col("_month").isNotNull()
    is_packed, is_ymd = F.col("_packed").isNotNull(), F.col("_ymd").isNotNull()
    year_named = F.coalesce(F.col("_year4").try_cast("int"), F.when(F.col("_before") != "", F.col("_year2").try_cast("int") + 2000))
    six = five.select(
        *kept,
        "_t",
        "_signed",
        "_d",
        (F.col("_clock").isNotNull() | is_packed).alias("_timed"),
        F.when(is_packed, at("_packed", 0)).when(is_ymd, at("_ymd", 0)).when(named, year_named).otherwise(F.when(c < 100, c + 2000).otherwise(c)).alias("_y"),
        F.when(is_packed, at("_packed", 1)).when(is_ymd, at("_ymd", 1)).when(named, F.col("_month")).otherwise(F.when(month_second, b).otherwise(a)).alias("_mo"),
        F.when(is_packed, at("_packed", 2)).when(is_ymd, at("_ymd", 2)).when(named, F.coalesce(F.col("_before").try_cast("int"), F.col("_after").try_cast("int"))).otherwise(F.when(month_second, a).otherwise(b)).alias("_dd"),
        F.when(is_packed, at("_packed", 3)).otherwise(at("_clock", 0)).alias("_h"),
        F.when(is_packed, at("_packed", 4)).otherwise(at("_clock", 1)).alias("_mi"),
        F.coalesce(F.when(is_packed, at("_packed", 5)).otherwise(at("_clock", 2)), F.lit(0)).alias("_se"),
        F.lower(F.get("_clock", F.lit(3))).alias("_half"),
    )
    h = F.col("_h")
    h24 = F.when(F.col("_half") == "p", F.when(h < 12, h + 12).otherwise(h)).when(F.col("_half") == "a", F.when(h == 12, 0).otherwise(h)).otherwise(h)
    ok = F.col("_y").between(1900, 2199) & F.col("_mo").between(1, 12) & F.col("_dd").between(1, 31) & F.col("_mi").between(0, 59) & h24.between(0, 23)
    stamp = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", "_y", "_mo", "_dd", h24, "_mi", F.least(F.col("_se"), F.lit(59)))
    sign, oh, om = (F.get("_signed", F.lit(k)) for k in (0, 1, 2))
    numeric = F.when(F.col("_timed") & oh.try_cast("int").between(0, 14) & om.try_cast("int").between(0, 59), F.concat(sign, oh, F.lit(":"), om))
    letters = _part("_t", r"(?:[\d:']|[AaPp][Mm]) ?\(?(Z|[A-Z]{2,4})\)?$", 1)
    short = F.create_map(*(F.lit(x) for pair in ABBREVIATIONS.items() for x in pair))[letters]
    region = _part("_t", r" \(?([A-Z][A-Za-z]+(?:/[A-Z][A-Za-z_+\-]+)+)\)?$", 1)
    seconds = F.when(F.col("_d").rlike(r"^\d{10}$"), F.col("_d").try_cast("bigint")).when(F.col("_d").rlike(r"^\d{13}$"), F.substring("_d", 1, 10).try_cast("bigint"))
    return six.select(
        *kept,
        F.when(ok, F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")).alias("wall"),
        F.coalesce(numeric, short).alias("offset"),
        region.alias("region"),
        (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("epoch"),
    )


def _known_regions(df: DataFrame) -> list[str]:
    """Region names that this JVM's time-zone data has (about 600, fixed by the data's version)."""
    ids = df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds().toArray()
    return sorted(str(x) for x in ids)


def _shift(wall: Column, offset: Column) -> Column:
    minutes = (F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 5, 2).cast("int")) * F.when(F.substring(offset, 1, 1) == "-", -1).otherwise(1)
    return wall - F.make_dt_interval(mins=minutes)


def _thread_key(subject: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(subject, r"(?i)^\s*((re|fw|fwd|aw|wg|tr)\s*:\s*)+", "")))


def _reply_depth(subject: Column) -> Column:
    prefix = F.regexp_extract(F.coalesce(subject, F.lit("")), r"(?i)^\s*((?:(?:re|fw|fwd|aw|wg|tr)\s*:\s*)*)", 1)
    return F.length(F.regexp_replace(prefix, "[^:]", ""))


def zone_violations(parsed: DataFrame, groups: DataFrame, group: str = "folder", declared: str = "home_zone") -> DataFrame:
    """``group``, ``zone``, ``violations``, ``apart``: for every group and candidate zone how often the order of events would be broken.

    ``parsed`` needs the group column, ``wall``, ``fixed`` (instant of texts with
    a written zone, else null), ``ingested_at`` and ``subject``. Candidates (offset histories)
    are the zones that any group declares, and UTC: a set as small as the zone list.
    Local times are aligned with the ingestion time and with the order of a
    thread (a reply must not precede the latest fixed instant one level up, nor follow the first one a level down);
    the counts are aggregated before anything is joined. ``apart`` counts the group's texts with a written zone
    whose wall clock is not the candidate's at that instant.
    """
    regions = _known_regions(parsed)
    # names of zones: no more than the zone data has, about 600
    named = groups.select(F.when(F.col(declared).isin(regions), F.col(declared)).alias("_z")).where("_z is not null").distinct().collect()
    candidates = sorted({"UTC"} | {r._z for r in named})
    keyed = parsed.select(group, "wall", "fixed", "ingested_at", _thread_key(F.col("subject")).alias("_thread"), _reply_depth(F.col("subject")).alias("_depth"))
    known = keyed.where("fixed is not null and _thread <> ''")
    parents = known.groupBy(group, "_thread", (F.col("_depth") + 1).alias("_depth")).agg(F.min("fixed").alias("_parent"))
    answers = known.where("_depth > 0").groupBy(group, "_thread", (F.col("_depth") - 1).alias("_depth")).agg(F.max("fixed").alias("_answer"))
    local = keyed.where("wall is not null").join(parents, [group, "_thread", "_depth"], "left").join(answers, [group, "_thread", "_depth"], "left")
    tried = local.withColumn("zone", F.explode(F.array(*(F.lit(z) for z in candidates))))
    instant = F.convert_timezone(F.col("zone"), F.lit("UTC"), F.col("wall"))
    broken = (instant > F.col("ingested_at").cast("timestamp_ntz"), instant < F.col("_parent"), instant > F.col("_answer"))
    count = sum((F.coalesce(b.cast("int"), F.lit(0)) for b in broken), F.lit(0))
    free = F.col("fixed").isNull()
    return tried.groupBy(group, "zone").agg(F.sum(F.when(free, count).otherwise(0)).alias("violations"), F.count_if(~free & (instant != F.col("fixed"))).alias("apart"))


def estimate_zones(parsed: DataFrame, groups: DataFrame, group: str = "folder", declared: str = "home_zone") -> DataFrame:
    """One zone per group: ``group``, ``zone``, ``violations``, ``best``, ``best_violations``, ``estimated``.

    ``best`` is the candidate with the fewest violations, of equals the one that agrees with most written zones, then UTC, then the first name. A declared zone
    is binding and taken as it is, with its own violations beside it; ``estimated`` groups declare none and take ``best``.
    """
    scores = zone_violations(parsed, groups, group, declared)
    known = groups.select(group, F.when(F.col(declared).isin(_known_regions(parsed)), F.col(declared)).alias("_z")).groupBy(group).agg(F.min("_z").alias("_declared"))
    rated = scores.groupBy(group).agg(F.min(F.struct("violations", "apart", (F.col("zone") != "UTC").alias("_other"), "zone")).alias("_best"))
    own = scores.join(known, group).where(F.col("zone") == F.col("_declared")).select(group, F.col("violations").alias("_own"))
    both = known.join(rated, group, "full").join(own, group, "left")
    estimated = F.col("_declared").isNull()
    return both.select(
        group, F.coalesce("_declared", "_best.zone").alias("zone"), F.when(estimated, F.col("_best.violations")).otherwise(F.coalesce("_own", F.lit(0))).alias("violations"),
        F.col("_best.zone").alias("best"), F.col("_best.violations").alias("best_violations"), estimated.alias("estimated"),
    )


def normalise_timestamps(messages: DataFrame, folders: DataFrame) -> DataFrame:
    """``msg_id``, ``instant`` (timestamp_ntz in UTC), ``instant_utc`` (text), ``basis``; one row per distinct key.

    ``basis`` is ``epoch``, ``offset``, ``region``, ``home`` (the declared zone), ``estimated`` or null. Empty inputs
    give no rows; a message in an unknown folder uses the estimated zone.
    """
    read = _read(messages, folders)
    zones = estimate_zones(read, folders)
    instant = F.coalesce(F.col("fixed"), F.convert_timezone(F.col("zone"), F.lit("UTC"), F.col("wall")))
    basis = F.when(F.col("epoch").isNotNull(), "epoch").when(F.col("wall").isNull(), None).when(F.col("offset").isNotNull(), "offset").when(F.col("fixed").isNotNull(), "region").when(F.col("estimated"), "estimated").otherwise("home")
    out = read.join(zones.select("folder", "zone", "estimated"), "folder", "left")
    return out.select("msg_id", F.date_trunc("second", instant).cast("timestamp_ntz").alias("instant"), F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant_utc"), basis.alias("basis"))


def zone_report(messages: DataFrame, folders: DataFrame) -> DataFrame:
    """The rows of :func:`estimate_zones` for the folders of messages."""
    return estimate_zones(_read(messages, folders), folders)


def _read(messages: DataFrame, folders: DataFrame) -> DataFrame:
    """Each message once, its time text read; written once, since it is read twice."""
    once = messages.groupBy("msg_id").agg(F.min(F.struct("date_str", "folder", "subject", "ingested_at")).alias("_m")).select("msg_id", "_m.*")
    order = folders.groupBy("folder").agg(F.max("day_first").alias("day_first"))
    read = parse_timestamp(once.join(order, "folder", "left"))
    region = F.when(F.col("region").isin(_known_regions(messages)), F.col("region"))
    fixed = F.coalesce(F.col("epoch"), _shift(F.col("wall"), F.col("offset")), F.convert_timezone(region, F.lit("UTC"), F.col("wall")))
    # filters must not be pushed into (and so repeat) the parsing
    return materialize(read.withColumn("fixed", fixed), "timestamps")
