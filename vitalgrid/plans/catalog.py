"""Named queries: each operator over the whole of a generated table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid import samples as S
from vitalgrid.functions import clock, paths
from vitalgrid.operators import align, audit, bbi, cleaners, hrv, sleep, survey, tracker
from vitalgrid.plans import device, intervals, runs, surveys
from vitalgrid.session import prepare_session, shared_folder
from vitalgrid.sinks import tables
from vitalgrid.sources import arrivals as A
from vitalgrid.sources import lines as L
from vitalgrid.sources import manifest as M
from vitalgrid.sources import types
from vitalgrid.streaming import batches, incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NOW_MS = 1_735_689_600_000
TODAY = "2025-01-01"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare_session(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# --- scalar functions -------------------------------------------------------


@query
def iso_minute(spark, sf_dir):
    df = S.iso_texts(S.events(spark, sf_dir))
    return df.select("event_id", clock.iso_minute(F.col("text")).alias("minute"))


@query
def iso_second(spark, sf_dir):
    df = S.iso_texts(S.events(spark, sf_dir))
    return df.select("event_id", clock.iso_second(F.col("text")).alias("second"))


@query
def iso_date(spark, sf_dir):
    df = S.iso_texts(S.events(spark, sf_dir))
    return df.select("event_id", clock.iso_date(F.col("text")).alias("day"))


@query
def time_of_day(spark, sf_dir):
    df = S.iso_texts(S.events(spark, sf_dir))
    return df.select("event_id", clock.time_of_day(F.col("text")).alias("part"))


@query
def epoch_day_time(spark, sf_dir):
    ms = F.col("ms")
    return S.events(spark, sf_dir).select(
        "event_id", clock.epoch_day(ms).alias("day"), clock.epoch_time(ms).alias("time"),
        clock.epoch_minute(ms).alias("minute"),
    )


@query
def participant_id(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir))
    path = F.col("path")
    return df.select(
        "event_id", paths.participant_id(path).alias("participant_id"),
        paths.participant_id(path, gz=True).alias("participant_id_gz"),
    )


@query
def path_columns(spark, sf_dir):
    df = M.with_path_columns(S.mixed_paths(S.events(spark, sf_dir)).drop("patient_id"))
    path = F.col("path")
    return df.select(
        "event_id", "patient_id", "data_type", "file_name",
        paths.base_name(path).alias("base_name"), paths.folder(path).alias("folder"),
        paths.stem(paths.base_name(path)).alias("stem"),
        paths.file_id(F.col("data_type"), F.col("file_name")).alias("file_id"),
        paths.batch_key(F.col("patient_id"), F.date_format("at", "yyyy-MM-dd")).alias("batch_key"),
        paths.survey_clean_path(path).alias("clean_path"),
    )


@query
def route_files(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir))
    return (
        df.select("event_id", paths.route(F.col("path")).alias("route"))
        .where(F.col("route").isNotNull())
    )


@query
def minute_keys(spark, sf_dir):
    df = S.iso_texts(S.events(spark, sf_dir))
    key = paths.minute_key(F.col("pid"), clock.iso_minute(F.col("text")))
    df = df.select("event_id", key.alias("key"))
    return df.select(
        "event_id", "key", paths.key_part(F.col("key"), 0).alias("participant_id"),
        paths.key_part(F.col("key"), 1).alias("timestamp"),
    )


# --- sources ----------------------------------------------------------------


@query
def arrival_json(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir))
    key = F.concat(F.url_encode("path"), F.lit("+%28"), F.col("event_type"), F.lit("%29"))
    record = F.concat(
        F.lit('{"eventSource":"aws:s3","s3":{"bucket":{"name":"in"},"object":{"key":"'), key, F.lit('"}}}')
    )
    other = F.lit('{"eventSource":"aws:sns","s3":{"bucket":{"name":"no"},"object":{"key":"no"}}}')
    bodies = [
        F.concat(F.lit('{"Records":['), record, F.lit("]}")),
        F.concat(F.lit('{"Records":['), other, F.lit(","), record, F.lit("]}")),
        record,
        F.concat(F.lit('{"Records":['), other, F.lit("]}")),
        F.lit("{not json"),
    ]
    df = df.withColumn("body", S.one_of(bodies))
    return A.parse_messages(df).select("event_id", "bucket", "object_key")


@query
def parse_preamble(spark, sf_dir):
    """Raw heart-rate files: positional header, rejects left out."""
    raw = S.raw(spark, sf_dir, "click")
    names = ["isoDate", "unixTimestampInMs", "beatsPerMinute", "status", "deviceType", "timezone"]
    text = S.device_lines(raw, ",".join(names), names)
    rows = L.records(text, L.positional_headers(text), names, len(names))
    return rows.select("source_file", (F.col("line_no") - 7).alias("event_id"), *names)


@query
def parse_marker_header(spark, sf_dir):
    """Questionnaire files: header by its first word, answers over many lines."""
    text = S.survey_lines(spark, sf_dir)
    names = ["timezone", "unixTimestampInMs", "isoDate", "role", "answer"]
    facts, found = L.survey_records(text)
    rows = L.records(found, facts, names, len(names))
    return rows.select("source_file", *names)


@query
def parse_bbi_header(spark, sf_dir):
    """Interval files whose header lies at an unknown line."""
    raw = S.bbi_rows(spark, sf_dir, native=True)
    names = ["timezone", "unixTimestampInMs", "isoDate", "bbi"]
    text = S.device_lines(raw, ",".join(names), names)
    rows = L.records(text, L.bbi_headers(text), names, len(names))
    return rows.select(
        "source_file", F.col("unixTimestampInMs").cast("bigint").alias("unixTimestampInMs"),
        F.round(F.col("bbi").cast("double"), 4).alias("bbi"),
    )


def _pair_lines(spark, sf_dir):
    raw = S.bbi_rows(spark, sf_dir, native=False)
    both = F.posexplode(F.array(F.col("timezone"), F.col("unixTimestampInMs").cast("string")))
    return raw.select("source_file", "line_no", both.alias("p", "line")).select(
        "source_file", (F.col("line_no") * 2 + F.col("p")).alias("line_no"), "line"
    )


@query
def parse_bbi_pairs(spark, sf_dir):
    pairs = L.zone_line_pairs(_pair_lines(spark, sf_dir))
    return pairs.select("source_file", "line_no", "timezone", "unixTimestampInMs")


@query
def parse_single_column(spark, sf_dir):
    return L.single_column(_pair_lines(spark, sf_dir))


@query
def decode_cascade(spark, sf_dir):
    """Documents as UTF-8, windows-1252 and latin-1 bytes by turns, all decoded again.

    The second kind ends with bytes that only windows-1252 has a letter for,
    the third with one that it has none for.
    """
    docs = S.table(spark, sf_dir, "documents")
    plain = F.regexp_replace("text", r"[^\x09\x0a\x20-\x7e\xa0-\xff]", "?")
    kind = F.col("doc_id") % 3
    ends = F.when(kind == 1, F.lit(" \x80\x93x\x94")).otherwise(F.lit(" \x81"))
    text = F.when(kind == 0, F.col("text")).otherwise(F.concat(plain, ends))
    # \n is one byte in both encodings, so lines are cut after encoding
    lines = docs.select(
        F.col("doc_id").cast("string").alias("source_file"), F.posexplode(F.split(text, "\n")).alias("p", "part"),
        "doc_id",
    ).select(
        "source_file", F.col("p").cast("bigint").alias("line_no"),
        F.when(kind == 0, F.col("part"))
        .otherwise(F.encode("part", "ISO-8859-1").cast("string")).alias("line"),
    )
    out = L.decode_lines(lines)
    return out.select(F.col("source_file").cast("bigint").alias("doc_id"), "line_no", "line")


@query
def manifest(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir)).select("path", F.floor("value").cast("bigint").alias("size"))
    return M.batch_files(M.with_suffix(df, ".csv", non_empty=True)).select(
        "path", "size", "patient_id", "data_type", "file_name"
    )


@query
def patients(spark, sf_dir):
    return M.patients(S.mixed_paths(S.events(spark, sf_dir)).select("path"))


@query
def bbi_paths(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir)).select("path", F.floor("value").cast("bigint").alias("size"))
    return M.bbi_paths(df).select("path", "size").distinct()


@query
def expected_counts(spark, sf_dir):
    return M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))


# --- cleaners ---------------------------------------------------------------


@query
def clean_heart_rate(spark, sf_dir):
    return cleaners.clean_heart_rate(S.raw(spark, sf_dir, "click"))


def _coarse_steps(spark, sf_dir):
    """Step rows cut to the day and to fifties, so that files hold copies."""
    day = F.col("unixTimestampInMs") - F.col("unixTimestampInMs") % 86_400_000
    coarse = F.floor(F.col("steps") / 50).cast("int")
    return S.raw(spark, sf_dir, "view").withColumns(
        {
            "unixTimestampInMs": day,
            "isoDate": F.concat(F.substring("isoDate", 1, 10), F.lit("T00:00:00Z")),
            "steps": coarse,
            "totalSteps": coarse * 10,
        }
    )


@query
def clean_step_dedup(spark, sf_dir):
    return cleaners.clean_step(_coarse_steps(spark, sf_dir))


@query
def clean_other(spark, sf_dir):
    return cleaners.clean_other(S.raw(spark, sf_dir, "signup"))


@query
def stack_files(spark, sf_dir):
    """Cleaned heart-rate files one below the other, key split."""
    return device.split_key(cleaners.clean_heart_rate(S.raw(spark, sf_dir, "click")))


@query
def file_audit(spark, sf_dir):
    before = _coarse_steps(spark, sf_dir)
    return audit.per_file(before, cleaners.clean_step(before))


@query
def run_totals(spark, sf_dir):
    before = _coarse_steps(spark, sf_dir)
    return audit.totals(audit.per_file(before, cleaners.clean_step(before)))


@query
def file_rejects(spark, sf_dir):
    """Files none of whose rows has a reading of ten or more."""
    raw = S.raw(spark, sf_dir, "purchase")
    files = raw.select("source_file").distinct()
    return audit.rejects(files, raw.where("stressLevel >= 10"))


# --- sleep ------------------------------------------------------------------


@query
def sleep_expand(spark, sf_dir):
    return sleep.clean_sleep(S.raw(spark, sf_dir, "error"), NOW_MS)


@query
def sleep_unit_inference(spark, sf_dir):
    raw = S.raw(spark, sf_dir, "error")
    seconds = raw.withColumn("durationInMs", F.floor(F.col("durationInMs") / 100).cast("bigint"))
    out = sleep.clean_sleep(seconds, NOW_MS)
    return out.select("source_file", "line_no", "minuteIndex", "originalDurationMinutes", "unixTimestampInMs")


@query
def sleep_defaults(spark, sf_dir):
    """Neither duration nor type nor epoch: all three are filled."""
    raw = S.raw(spark, sf_dir, "error").withColumn(
        "timestamp", F.date_format(F.timestamp_millis("unixTimestampInMs"), "MM/dd/yyyy HH:mm:ss")
    )
    return sleep.clean_sleep(raw.select("timestamp", "source_file", "line_no"), NOW_MS)


@query
def sleep_fallback(spark, sf_dir):
    """Mostly non-positive durations: files without a positive one stay as is."""
    raw = S.raw(spark, sf_dir, "error").withColumn("durationInMs", F.col("durationInMs") - 60_000)
    return sleep.clean_sleep(raw, NOW_MS).select(
        "participant_id", "source_file", "line_no", "unixTimestampInMs", "durationInMs", "minuteIndex", "originalIndex"
    )


# --- alignment --------------------------------------------------------------


@query
def align_spine(spark, sf_dir):
    df = align.spine(S.prepared_frames(spark, sf_dir, "day"))
    return df.select("participant_id", "timestamp", *[f"{c}{i}" for c in "dn" for i in range(6)])


@query
def align_row_counts(spark, sf_dir):
    """Rows each key will give, by counting only."""
    df = align.expected_rows(S.prepared_frames(spark, sf_dir, "day"))
    return df.select("participant_id", "timestamp", "rows")


@query
def align_metrics(spark, sf_dir):
    return align.aligned(S.prepared_frames(spark, sf_dir, "minute"))


@query
def align_defaults(spark, sf_dir):
    """Two types present, four absent."""
    frames = S.prepared_frames(spark, sf_dir, "hour")
    return align.aligned({K.HEART_RATE: frames[K.HEART_RATE], K.STRESS: frames[K.STRESS]})


@query
def align_fanout(spark, sf_dir):
    return align.aligned(S.prepared_frames(spark, sf_dir, "hour"))


@query
def align_crowded(spark, sf_dir):
    """The join path, taken for every key with two readings of a type."""
    return align.aligned(S.prepared_frames(spark, sf_dir, "hour"), crowded=1)


@query
def align_latest(spark, sf_dir):
    return align.aligned(S.prepared_frames(spark, sf_dir, "day"), mode="latest")


@query
def align_cleaned(spark, sf_dir):
    """Raw rows through the cleaners into the aligned table, in one plan."""
    return device.align_cleaned(
        {
            K.HEART_RATE: cleaners.clean_heart_rate(S.raw(spark, sf_dir, "click")),
            K.SLEEP: sleep.clean_sleep(S.raw(spark, sf_dir, "error"), NOW_MS),
            K.STEP: cleaners.clean_step(S.raw(spark, sf_dir, "view")),
            K.RESPIRATION: cleaners.clean_other(S.raw(spark, sf_dir, "signup")),
            K.STRESS: cleaners.clean_other(S.raw(spark, sf_dir, "purchase")),
        }
    )


@query
def align_files(spark, sf_dir):
    """Files of all types, as their lines, to the aligned table: headers of two forms, quoted fields."""
    rows, _ = device.run(S.device_files(spark, sf_dir), NOW_MS)
    return rows


@query
def merged_names(spark, sf_dir):
    return align.merged_names(align.aligned(S.prepared_frames(spark, sf_dir, "hour")), TODAY)


# --- intervals --------------------------------------------------------------


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 4) for n in names})


@query
def bbi_derive(spark, sf_dir):
    df = bbi.interval_differences(S.bbi_rows(spark, sf_dir, native=False))
    return df.select("participant_id", "source_file", "line_no", "unixTimestampInMs", "bbi", "bbi_diff")


@query
def bbi_diff(spark, sf_dir):
    df = bbi.interval_differences(S.bbi_rows(spark, sf_dir, native=True))
    return _rounded(
        df.select("source_file", "line_no", "bbi", "bbi_diff", "bbi_diff_squared"),
        "bbi", "bbi_diff", "bbi_diff_squared",
    )


@query
def bbi_stats(spark, sf_dir):
    df = bbi.interval_differences(S.bbi_rows(spark, sf_dir, native=False))
    return _rounded(bbi.interval_statistics(df), "bbi_avg")


@query
def hrv_summary(spark, sf_dir):
    df = bbi.interval_differences(S.bbi_rows(spark, sf_dir, native=True))
    return hrv.summarise(df)


@query
def hrv_no_diff(spark, sf_dir):
    df = bbi.tag_bbi_participant(S.bbi_rows(spark, sf_dir, native=True))
    return hrv.summarise(df)


@query
def hrv_missing(spark, sf_dir):
    df = S.bbi_rows(spark, sf_dir, native=True).drop("bbi")
    return hrv.summarise(df)


@query
def hrv_merge(spark, sf_dir):
    df = bbi.interval_differences(S.bbi_rows(spark, sf_dir, native=True))
    return hrv.merge_folders(hrv.summarise(df), TODAY).select(
        "participantId_date", "isoDate", "mean_bbi", "record_count", "folder", "merged_file"
    )


@query
def interval_files(spark, sf_dir):
    """Raw files of all kinds to preprocessed files, read back with their types, to HRV rows with their merged file."""
    home = f"{shared_folder(spark)}/intervals-{uuid.uuid4().hex}"
    intervals.preprocess(S.interval_files(spark, sf_dir), home)
    rows, _ = intervals.merged(intervals.read_preprocessed(spark, home)[0], TODAY)
    return rows.select(
        "source_file", "participantId_date", "participant_id", "isoDate", *hrv.METRICS, "folder", "merged_file"
    )


@query
def column_types(spark, sf_dir):
    """The type of each column in each file, and over all files."""
    rows = S.mixed_table(spark, sf_dir)
    names = rows.columns[2:]
    own = types.file_types(rows, names)
    return own.unionByName(types.file_types(rows.withColumn("source_file", F.lit("*")), names))


@query
def typed_cells(spark, sf_dir):
    """The same table with the types that hold all files' values."""
    rows = S.mixed_table(spark, sf_dir).drop("mixed")
    return types.typed(rows, types.common_types(rows, rows.columns[2:]))


@query
def run_summaries(spark, sf_dir):
    """What every flow took in, wrote and removed, counted while it wrote."""
    home = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    told = [runs.clean(lines, t, NOW_MS, f"{home}/device", "one") for t, lines in S.device_files(spark, sf_dir).items()]
    told.append(runs.preprocess(S.interval_files(spark, sf_dir), f"{home}/intervals", "one"))
    told.append(runs.normalise(S.survey_lines(spark, sf_dir), f"{home}/surveys", "one"))
    return reduce(DataFrame.unionByName, told)


# --- questionnaires ---------------------------------------------------------


@query
def survey_normalise(spark, sf_dir):
    names = ["timezone", "unixTimestampInMs", "isoDate", "role", "answer"]
    df = survey.normalise_files(S.survey_lines(spark, sf_dir), len(names), names)
    return df.drop("line_no")


@query
def survey_files(spark, sf_dir):
    """Raw forms to cleaned files to the merged table; forms with a surplus cell are rejected."""
    text = S.survey_lines(spark, sf_dir)
    surplus = F.col("source_file").endswith("7.csv") & (F.col("line_no") >= 100) & F.col("line").startswith("UTC,")
    text = text.withColumn("line", F.when(surplus, F.concat(F.lit("more,"), "line")).otherwise(F.col("line")))
    home = f"{shared_folder(spark)}/surveys-{uuid.uuid4().hex}"
    surveys.write_cleaned(surveys.normalise_lines(text)[0], f"{home}/clean")
    surveys.merge_into(spark, f"{home}/clean", f"{home}/merged")
    names = ["patient_folder", "patient_id", "timezone", "isoDate", "role", "answer", "time_of_day"]
    return tables.read_surveys(spark, f"{home}/merged").select(*names)


@query
def survey_preamble(spark, sf_dir):
    text = S.survey_lines(spark, sf_dir)
    return survey.preamble_patients(text, L.survey_headers(text)).select("source_file", "patient_id")


@query
def survey_merge(spark, sf_dir):
    """Three sets with different columns, put together by name."""
    asked = S.survey_rows(spark, sf_dir, "user").withColumn("mood", F.col("answer"))
    return survey.merge([asked, S.survey_rows(spark, sf_dir, "assistant"), S.survey_rows(spark, sf_dir, "system")])


@query
def survey_upsert(spark, sf_dir):
    """The system's rows are there already; all rows arrive."""
    old = S.survey_rows(spark, sf_dir, "system")
    return survey.upsert(old, S.survey_rows(spark, sf_dir))


@query
def survey_names(spark, sf_dir):
    return survey.earliest_names(S.survey_rows(spark, sf_dir))


@query
def survey_batch_status(spark, sf_dir):
    df = S.mixed_paths(S.events(spark, sf_dir))
    came = tracker.arrivals(df.drop("patient_id"), [K.QUESTIONNAIRE], path="path", at="at")
    listed = M.batch_files(df.drop("patient_id").where("value >= 20"), [K.QUESTIONNAIRE])
    return tracker.survey_status(came, M.expected_counts(listed, ".csv", ".json"))


# --- batch completion -------------------------------------------------------


def _tracked(spark, sf_dir):
    came = tracker.arrivals(S.arrivals(spark, sf_dir))
    return came, M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))


@query
def batch_counters(spark, sf_dir):
    return tracker.counters(_tracked(spark, sf_dir)[0])


@query
def batch_status(spark, sf_dir):
    return tracker.status(*_tracked(spark, sf_dir))


@query
def batch_progress(spark, sf_dir):
    return tracker.progress_text(tracker.type_progress(*_tracked(spark, sf_dir)))


@query
def batch_first_complete(spark, sf_dir):
    return tracker.first_complete(*_tracked(spark, sf_dir))


@query
def batch_manifest_mode(spark, sf_dir):
    """All listed types count from the start."""
    return tracker.first_complete(*_tracked(spark, sf_dir), known_types="manifest")


@query
def batch_outcomes(spark, sf_dir):
    came, expected = _tracked(spark, sf_dir)
    return tracker.outcomes(came, expected, "arrival_id").select("arrival_id", "outcome")


@query
def batch_events(spark, sf_dir):
    done = tracker.first_complete(*_tracked(spark, sf_dir))
    return tracker.completion_events(done, {"device": "merge", "intervals": "preprocess"})


def _forms(spark, sf_dir):
    came = tracker.arrivals(S.form_arrivals(S.events(spark, sf_dir)), [K.QUESTIONNAIRE])
    return came, M.expected_counts(M.batch_files(S.form_listing(spark, sf_dir), [K.QUESTIONNAIRE]))


@query
def survey_first_complete(spark, sf_dir):
    """Questionnaire batches at the moment all their forms are there."""
    return tracker.first_complete(*_forms(spark, sf_dir))


@query
def survey_outcomes(spark, sf_dir):
    """Every sending of a form as duplicate, counted or triggered."""
    came, expected = _forms(spark, sf_dir)
    return tracker.outcomes(came, expected, "arrival_id").select("arrival_id", "outcome")


# --- streams ----------------------------------------------------------------


def _stream(spark, sf_dir):
    """The arrivals as a stream over the table's file."""
    return batches.read_arrivals(spark, sf_dir, S.SCHEMAS["events"], glob="events.parquet")


def _stream_arrivals(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    one_day = F.timestamp_micros(
        F.lit(1_706_745_600_000_000) + F.floor((F.unix_micros(at) - 1_704_067_200_000_000) / 31)
    )
    pid = F.lpad(F.hex("user_id"), 8, "0")
    key = F.concat(F.lit("P"), F.col("user_id").cast("string"), F.lit("_"), pid, F.lit("/"), S.acts_as(),
                   F.lit("/f"), F.col("event_id").cast("string"), F.lit(".csv"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    sendings = F.when(k >= 50, F.array(F.lit(0), F.lit(10))).otherwise(F.array(F.lit(0)))
    return (
        _stream(spark, sf_dir)
        .select("event_id", key.alias("object_key"), one_day.alias("sent_at"), F.explode(sendings).alias("later"))
        .select(
            "object_key",
            (F.col("sent_at") + F.make_dt_interval(mins=F.col("later"))).alias("arrived_at"),
            (F.col("event_id") * 2 + F.signum("later").cast("bigint")).alias("arrival_id"),
        )
    )


def _drained(spark, stream) -> DataFrame:
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    tasks = spark.sparkContext.defaultParallelism
    batches.drain_to_table(stream, f"{home}/table", f"{home}/checkpoint", state_partitions=tasks)
    return spark.read.schema(stream.schema).parquet(f"{home}/table")


@query
def stream_dedup(spark, sf_dir):
    """Distinct files per batch, from a stream with repeated sendings."""
    stream = batches.distinct_arrivals(tracker.arrivals(_stream_arrivals(spark, sf_dir)))
    return _drained(spark, stream.select("batch_key", "file_id"))


@query
def stream_batch_status(spark, sf_dir):
    """Completed batches from a stream; equal to the batch form."""
    expected = M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))
    stream = batches.completions(batches.arrivals_of(_stream_arrivals(spark, sf_dir), expected))
    return _drained(spark, stream)


@query
def stream_survey_status(spark, sf_dir):
    """Completed questionnaire batches from a stream; equal to the batch form."""
    _, expected = _forms(spark, sf_dir)
    pid = F.lpad(F.hex("user_id"), 8, "0")
    sent = _stream(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp")).withColumn(
        "patient_id", F.concat(F.lit("P"), F.col("user_id").cast("string"), F.lit("_"), pid)
    )
    forms = [K.QUESTIONNAIRE]
    stream = batches.arrivals_of(S.form_arrivals(sent).drop("arrival_id"), expected, types=forms)
    return _drained(spark, batches.completions(stream, forms))


def _body(key: Column) -> Column:
    return F.concat(
        F.lit('{"Records":[{"eventSource":"aws:s3","s3":{"bucket":{"name":"in"},"object":{"key":"'), F.url_encode(key), F.lit('"}}}]}')
    )


def _applied(spark, messages: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """A stream of messages run to its end; one of its tables."""
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    incremental.run(messages, home, expected)
    return incremental.table(spark, home, name)


@query
def stream_outcomes(spark, sf_dir):
    """Every sending from a stream of JSON messages as duplicate, counted or triggered; equal to the batch form."""
    expected = M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))
    sent = _stream_arrivals(spark, sf_dir).select(
        F.lpad(F.col("arrival_id").cast("string"), 20, "0").alias("message_id"), _body(F.col("object_key")).alias("body"), "arrived_at"
    )
    made = _applied(spark, sent, expected, "outcomes")
    return made.select(F.col("message_id").cast("bigint").alias("arrival_id"), "outcome")


@query
def stream_completions(spark, sf_dir):
    """Completed batches from a stream of JSON messages."""
    expected = M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))
    sent = _stream_arrivals(spark, sf_dir).select(
        F.col("arrival_id").cast("string").alias("message_id"), _body(F.col("object_key")).alias("body"), "arrived_at"
    )
    made = _applied(spark, sent, expected, "completed")
    return made.select("batch_key", "patient_id", "completed_at", "total_files")


@query
def stream_letters(spark, sf_dir):
    """Unreadable messages, each sent up to eight times: tries and dead letters."""
    expected = M.expected_counts(M.batch_files(S.listing(spark, sf_dir)))
    k = F.get_json_object("props", "$.k").cast("bigint")
    key = F.concat(F.lit("P"), F.col("user_id").cast("string"), F.lit("/"), S.acts_as(), F.lit("/f.csv"))
    body = F.when(k % 5 < 3, _body(key)).when(k % 5 == 3, F.lit('{"Records":[]}')).otherwise(F.lit("{not json"))
    sent = _stream(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("message_id"), body.alias("body"),
        F.explode(F.sequence(F.lit(0), (k % 8).cast("int"))).alias("again"), F.col("ts").cast("timestamp").alias("ts"),
    ).select("message_id", "body", (F.col("ts") + F.make_dt_interval(mins=F.col("again"))).alias("arrived_at"))
    made = _applied(spark, sent, expected, "rejects")
    return made.select(F.col("message_id").cast("bigint").alias("event_id"), "tries", "state")
