"""Views of the generated tables as device files, surveys and arrivals.

``events`` rows stand in for readings: one file per user, type and day. The
views are projections, so a plan on them grows with the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid import constants as K

ACTS_AS = {
    "click": K.HEART_RATE,
    "error": K.SLEEP,
    "view": K.STEP,
    "signup": K.RESPIRATION,
    "purchase": K.STRESS,
}
PREAMBLE = ("Study export", "projectId,1", "device,watch", "zone,UTC", "generated,yes", "notes,none")


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table; its schema is known, so no file is opened to plan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def made(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later steps find ready, as if it had been read.

    Without the generator the optimizer would put the making of the text into
    every expression that uses it.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def acts_as() -> Column:
    kind = F.col("event_type")
    out = F.lit(None).cast("string")
    for name, data_type in ACTS_AS.items():
        out = F.when(kind == name, F.lit(data_type)).otherwise(out)
    return out


def device_path(data_type: Column) -> Column:
    """``{patient}/{type}/{yyMMdd}_{type}_{patient}_{pid}.csv``"""
    return F.concat(
        F.col("patient_id"), F.lit("/"), data_type, F.lit("/"),
        F.date_format("at", "yyMMdd"), F.lit("_"), data_type, F.lit("_"), F.col("patient_id"), F.lit(".csv"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns every view uses."""
    at = F.col("ts").cast("timestamp")
    pid = F.lpad(F.hex("user_id"), 8, "0")
    return table(spark, sf_dir, "events").select(
        "*",
        at.alias("at"),
        F.unix_millis(at).alias("ms"),
        pid.alias("pid"),
        F.concat(F.lit("P"), F.col("user_id").cast("string"), F.lit("_"), pid).alias("patient_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def raw(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Raw rows of one device type, as its files would hold them."""
    return raw_of(events(spark, sf_dir), event_type)


def raw_of(df: DataFrame, event_type: str) -> DataFrame:
    df = df.where(F.col("event_type") == event_type)
    trace = [device_path(F.lit(ACTS_AS[event_type])).alias("source_file"), F.col("event_id").alias("line_no")]
    iso, ms = F.col("iso").alias("isoDate"), F.col("ms").alias("unixTimestampInMs")
    whole = F.floor("value").cast("int")
    device, zone = F.lit("WATCH").alias("deviceType"), F.lit("UTC").alias("timezone")
    cells = {
        "click": [iso, ms, whole.alias("beatsPerMinute"), F.lit("VALID").alias("status"), device, zone],
        "view": [iso, ms, whole.alias("steps"), (whole * 10).alias("totalSteps"),
                 F.lit(60000).alias("durationInMs"), device, zone],
        "signup": [iso, ms, whole.alias("breathsPerMinute"), device, zone],
        "purchase": [iso, ms, whole.alias("stressLevel"), device, zone],
        "error": [iso, ms, F.element_at(F.array(F.lit("light"), F.lit("deep"), F.lit("rem")),
                                        (F.col("k") % 3 + 1).cast("int")).alias("type"),
                  F.floor(F.col("value") * 1000).cast("bigint").alias("durationInMs"),
                  F.lit(0).alias("timezoneOffsetInMs")],
    }[event_type]
    return made(df.select(*cells, *trace), "source_file", F.col("source_file"))


def prepared_frames(spark: SparkSession, sf_dir: str, grain: str) -> dict[str, DataFrame]:
    """Keyed readings per type, at minute, hour or day grain."""
    pattern = {"minute": "yyyy-MM-dd HH:mm", "hour": "yyyy-MM-dd HH", "day": "yyyy-MM-dd"}[grain]
    names = {"click": ["beatsPerMinute"], "view": ["steps", "totalSteps"], "signup": ["breathsPerMinute"],
             "purchase": ["stressLevel"], "error": ["durationInMs", "type"]}
    out = {}
    all_events = events(spark, sf_dir)
    for event_type, data_type in ACTS_AS.items():
        df = raw_of(all_events, event_type)
        at = F.timestamp_millis("unixTimestampInMs")
        out[data_type] = df.select(
            F.substring(F.substring_index("source_file", "_", -1), 1, 8).alias("participant_id"),
            F.date_format(at, pattern).alias("timestamp"),
            "unixTimestampInMs",
            *names[event_type],
        )
    return out


def bbi_rows(spark: SparkSession, sf_dir: str, native: bool) -> DataFrame:
    """Interval rows of all events; one file per user and day."""
    cells = [F.lit("America/New_York").alias("timezone"), F.col("ms").alias("unixTimestampInMs"),
             F.col("iso").alias("isoDate")]
    if native:
        cells.append((F.col("value") + 600).alias("bbi"))
    return events(spark, sf_dir).select(
        *cells, device_path(F.lit(K.BBI_FOLDER)).alias("source_file"), F.col("event_id").alias("line_no")
    )


def one_of(choices: list[Column]) -> Column:
    """A choice per row by ``k``; only the chosen one is computed."""
    out = choices[-1]
    for i in reversed(range(len(choices) - 1)):
        out = F.when(F.col("k") % len(choices) == i, choices[i]).otherwise(out)
    return out


def iso_texts(df: DataFrame) -> DataFrame:
    """Add ``text``: the event's time in six spellings, one of them broken."""
    f = lambda p: F.date_format("at", p)
    spellings = [
        f("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.concat(f("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")),
        f("yyyy-MM-dd HH:mm:ss"),
        f("yyyyMMdd'T'HHmmss'Z'"),
        F.concat(F.lit("bad-"), f("yyyy-MM-dd")),
        f("yyyy-MM-dd"),
    ]
    return made(df, "text", one_of(spellings))


def mixed_paths(df: DataFrame) -> DataFrame:
    """Add ``path``: device keys, forms, unknown folders and short keys."""
    name = F.concat(F.date_format("at", "yyMMdd"), F.lit("_r_"), F.col("patient_id"))
    head = F.concat(F.col("patient_id"), F.lit("/"))
    kinds = [
        F.concat(head, acts_as(), F.lit("/"), name, F.lit(".csv")),
        F.concat(head, F.lit("questionnaire/Physical-Capacity-Aw_6274612c/"), name, F.lit(".csv")),
        F.concat(head, F.lit("questionnaire/Mood_1/"), name, F.lit(".csv")),
        F.concat(head, F.lit(K.BBI_FOLDER), F.lit("/"), name, F.lit(".csv.gz")),
        F.concat(head, F.lit(K.PULSE_OX), F.lit("/"), name, F.lit(".v1.csv")),
        F.concat(F.lit("error_logs/"), name, F.lit(".txt")),
    ]
    return made(df, "path", one_of(kinds))


def device_lines(df: DataFrame, header: str, cells: list[str]) -> DataFrame:
    """Raw rows as the lines of their files: preamble, header, data."""
    top = [*PREAMBLE, header]
    files = df.select("source_file").distinct()
    opening = files.select(
        "source_file",
        F.posexplode(F.array(*[F.lit(t) for t in top])).alias("line_no", "line"),
    ).select("source_file", F.col("line_no").cast("bigint").alias("line_no"), "line")
    body = df.select(
        "source_file",
        (F.col("line_no") + len(top)).alias("line_no"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in cells]).alias("line"),
    )
    return opening.unionByName(body)


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def survey_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as questionnaire files; answers may run over lines."""
    talk = table(spark, sf_dir, "conversations")
    path = F.concat(F.lit("S"), F.col("conv_id").cast("string"), F.lit("/questionnaire/form_"),
                    F.col("conv_id").cast("string"), F.lit(".csv")).alias("source_file")
    pid = F.lpad(F.hex("conv_id"), 8, "0")
    top = [F.lit("projectId, participantId ,site"), F.lit(""), F.concat(F.lit('"pro,ject", '), pid, F.lit(" ,x")),
           F.lit("key,question"), F.lit("q1,How are you"), F.lit("timezone,unixTimestampInMs,isoDate,role,answer")]
    opening = talk.select("conv_id").distinct().select(
        path, F.posexplode(F.array(*top)).alias("p", "line")
    ).select("source_file", F.col("p").cast("bigint").alias("line_no"), "line")
    record = F.concat_ws(",", F.lit("UTC"), F.lit("1"), survey_iso(), F.col("role"), quoted(F.col("text")))
    body = talk.select(path, "turn", F.posexplode(F.split(record, "\n")).alias("p", "line")).select(
        "source_file", (F.lit(100) + F.col("turn") * (1 << 31) + F.col("p")).alias("line_no"), "line"
    )
    return opening.unionByName(body)


def survey_iso() -> Column:
    """A time per answer, from the turn."""
    hour = F.lpad((F.col("turn") * 5 % 24).cast("string"), 2, "0")
    day = F.lpad((F.col("conv_id") % 28 + 1).cast("string"), 2, "0")
    return F.concat(F.lit("2025-03-"), day, F.lit("T"), hour, F.lit(":30:15Z"))


def survey_rows(spark: SparkSession, sf_dir: str, role: str | None = None) -> DataFrame:
    """Normalised answers of twenty patients' folders."""
    talk = table(spark, sf_dir, "conversations")
    if role:
        talk = talk.where(F.col("role") == role)
    return talk.select(
        F.concat(F.lit("S"), (F.col("conv_id") % 20).cast("string")).alias("patient_folder"),
        survey_iso().alias("isoDate"),
        F.col("role"),
        F.col("text").alias("answer"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File arrivals: every reading is a file of its patient's one busy day.

    Those with k from 50 on are sent again ten minutes later.
    """
    one_day = F.timestamp_micros(
        F.lit(1_706_745_600_000_000) + F.floor((F.unix_micros("at") - 1_704_067_200_000_000) / 31)
    )
    sent = events(spark, sf_dir)
    key = F.concat("patient_id", F.lit("/"), acts_as(), F.lit("/f"), F.col("event_id").cast("string"), F.lit(".csv"))
    sent = made(sent.withColumn("arrived_at", one_day), "object_key", key)
    sendings = F.when(F.col("k") >= 50, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return sent.withColumn("again", F.explode(sendings)).select(
        (F.col("event_id") * 2 + F.col("again")).alias("arrival_id"),
        "object_key",
        (F.col("arrived_at") + F.make_dt_interval(mins=F.col("again") * 10)).alias("arrived_at"),
    )


def busy_day(at: Column) -> Column:
    """The time of day on one day to which a month shrinks."""
    return F.timestamp_micros(F.lit(1_706_745_600_000_000) + F.floor((F.unix_micros(at) - 1_704_067_200_000_000) / 31))


def form_key(suffix: Column) -> Column:
    """A questionnaire's key; two readings in a row are sendings of one form."""
    return F.concat("patient_id", F.lit(f"/{K.QUESTIONNAIRE}/f"), F.floor(F.col("event_id") / 2).cast("string"), suffix)


def form_arrivals(df: DataFrame) -> DataFrame:
    """Every event as the arrival of a form, some twice."""
    key = form_key(F.lit(".csv"))
    return df.select(F.col("event_id").alias("arrival_id"), key.alias("object_key"), busy_day(F.col("at")).alias("arrived_at"))


def form_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forms, and one more for every 97th event that never arrives."""
    lost = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(".csv"), F.lit("_lost.csv"))).otherwise(F.array(F.lit(".csv")))
    named = events(spark, sf_dir).withColumn("suffix", F.explode(lost))
    return made(named, "path", form_key(F.col("suffix"))).select("path", F.lit(1).cast("bigint").alias("size")).distinct()


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source listing: without empty files (below 1), which arrive all the
    same, and with one more file for every 97th that never arrives."""
    listed = events(spark, sf_dir).where("value >= 1")
    key = F.concat("patient_id", F.lit("/"), acts_as(), F.lit("/f"), F.col("event_id").cast("string"))
    lost = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(".csv"), F.lit("_lost.csv"))).otherwise(F.array(F.lit(".csv")))
    named = listed.withColumn("suffix", F.explode(lost))
    return made(named, "path", F.concat(key, F.col("suffix"))).select("path", F.floor("value").cast("bigint").alias("size"))


def device_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All events as the lines of their types' files, by type.

    Users with an odd number write heart-rate files in another form: quoted
    names and values, another order of columns and another name of the metric.
    """
    all_events = events(spark, sf_dir)
    out = {}
    for event_type, data_type in ACTS_AS.items():
        parts = []
        df = raw_of(all_events, event_type)
        names = [c for c in df.columns if c not in ("source_file", "line_no")]
        if event_type == "click":
            odd = F.conv(F.substring(F.substring_index("source_file", "_", -1), 1, 8), 16, 10).cast("bigint") % 2 == 1
            other = ["beatsPerMinute", *[c for c in names if c != "beatsPerMinute"]]
            texts = df.where(odd).select("source_file", "line_no", *[quoted(F.col(c).cast("string")).alias(c) for c in other])
            parts.append(device_lines(texts, '"heartRate",' + ",".join(f'"{c}"' for c in other[1:]), other))
            df = df.where(~odd)
        parts.append(device_lines(df, ",".join(names), names))
        out[data_type] = reduce(DataFrame.unionByName, parts)
    return out


def interval_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as the lines of interval files, by user in four forms.

    With intervals, without them, as pairs of a zone line and an epoch, and as
    plain lines.
    """
    form = F.conv(F.substring(F.substring_index("source_file", "_", -1), 1, 8), 16, 10).cast("bigint") % 4
    rows = bbi_rows(spark, sf_dir, native=True)
    names = ["timezone", "unixTimestampInMs", "isoDate", "bbi"]
    native = device_lines(rows.where(form == 0), ",".join(names), names)
    bare = device_lines(rows.where(form == 1), ",".join(names[:3]), names[:3])
    both = F.posexplode(F.array(F.col("timezone"), F.col("unixTimestampInMs").cast("string")))
    pairs = rows.where(form == 2).select("source_file", "line_no", both.alias("p", "line")).select(
        "source_file", (F.col("line_no") * 2 + F.col("p")).alias("line_no"), "line"
    )
    plain = rows.where(form == 3).select("source_file", "line_no", F.concat("isoDate", F.lit(",x")).alias("line"))
    return reduce(DataFrame.unionByName, [native, bare, pairs, plain])


def mixed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of many kinds, files of a user and day: what type a column has differs between files."""
    k, pick = F.col("k"), F.col("user_id") % 4
    text = F.when(pick == 0, k.cast("string")).when(pick == 1, F.col("ms").cast("string"))
    text = text.when(pick == 2, F.format_string("%.3f", "value")).otherwise(F.col("iso"))
    when = F.when(k % 3 == 0, F.col("iso")).otherwise(F.date_format("at", "yyyy-MM-dd"))
    return events(spark, sf_dir).select(
        device_path(F.lit(K.BBI_FOLDER)).alias("source_file"), F.col("event_id").alias("line_no"), k.cast("string").alias("whole"),
        F.when(k % 5 == 0, F.lit("")).otherwise(text).alias("mixed"), when.alias("when"),
        F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("False")).alias("flag"), F.col("event_type").alias("word"),
        F.when(k == 1, k.cast("string")).alias("rare"),
    )
