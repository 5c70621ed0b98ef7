"""Names, formats and limits that decide results.

They are part of the data contract (folder names, column names, defaults,
plausible ranges) and are listed here as they are.
"""

from __future__ import annotations

HEART_RATE = "garmin-device-heart-rate"
SLEEP = "garmin-connect-sleep-stage"
STEP = "garmin-device-step"
RESPIRATION = "garmin-device-respiration"
STRESS = "garmin-device-stress"
PULSE_OX = "garmin-device-pulse-ox"
BBI_FOLDER = "garmin-device-bbi"
QUESTIONNAIRE = "questionnaire"
QUESTIONNAIRE_FORM = "Physical-Capacity"

# Order in which epochs are taken over when several types share a minute.
DEVICE_TYPES = (HEART_RATE, SLEEP, STEP, RESPIRATION, STRESS, PULSE_OX)
OTHER_TYPES = (RESPIRATION, STRESS, PULSE_OX)

# Folders that are not patients.
RESERVED_FOLDERS = ("initial_append", "error_logs")

PREAMBLE_LINES = 6
SURVEY_HEADER_START = "timezone"
# Columns by which a header line is known.
TIME_COLUMNS = ("timezone", "isoDate", "unixTimestampInMs", "beatsPerMinute", "Timestamp")
BBI_HEADER_MARK = "timezone,unixTimestampInMs"
BBI_ZONE_MARK = "America/New_York"

PARTICIPANT_ID_PATTERN = r"_([a-zA-Z0-9]{8})\.csv$"
PARTICIPANT_ID_PATTERN_GZ = r"_([a-zA-Z0-9]{8})\.csv(?:\.gz)?$"

HEART_RATE_DROPS = ("status", "deviceType", "timezone", "isoDate")
STEP_DROPS = ("durationInMs", "deviceType", "timezone", "isoDate")
SLEEP_DROPS = ("timezoneOffsetInMs", "isoDate")
OTHER_DROPS = ("timezone", "isoDate", "deviceType")

MINUTE_MS = 60_000
SECONDS_LOOKALIKE_BELOW = 1000
DEFAULT_DURATION_MS = 60_000
DEFAULT_SLEEP_TYPE = "light"
DEFAULT_SLEEP_ID = "sleep_session_1"

BBI_PLAUSIBLE = (200, 2000)
EPOCH_PLAUSIBLE = (946_684_800_000, 4_102_444_800_000)

ALIGNED_COLUMNS = (
    "participantid_timestamp",
    "participantId_date",
    "participant_id",
    "timestamp",
    "unixTimestampInMs",
    "day",
    "time",
    "beatsPerMinute",
    "stressLevel",
    "steps",
    "totalSteps",
    "breathsPerMinute",
    "spo2",
    "durationInMs",
    "sleepType",
)

# Texts a CSV reader of device files takes for a missing value (the public
# defaults of pandas.read_csv).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
