"""Record schemas, enumerations and the fixed values of the behaviour log."""

from __future__ import annotations

from pyspark.sql import types as T


def _required(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, nullable=False)


def _optional(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, nullable=True)


# The record a batch or realtime writer produces: every field is mandatory.
B8 = T.StructType(
    [
        _required("record_id", T.StringType()),
        _required("student_id", T.StringType()),
        _required("student_name", T.StringType()),
        _required("course_id", T.StringType()),
        _required("course_name", T.StringType()),
        _required("behavior_type", T.StringType()),
        _required("duration", T.LongType()),
        _required("timestamp", T.StringType()),
    ]
)

# The detailed record: no record_id, but device, address, chapter and score.
B11 = T.StructType(
    [
        _optional("student_id", T.StringType()),
        _optional("student_name", T.StringType()),
        _optional("course_id", T.StringType()),
        _optional("course_name", T.StringType()),
        _optional("behavior_type", T.StringType()),
        _optional("duration", T.LongType()),
        _optional("timestamp", T.StringType()),
        _optional("ip_address", T.StringType()),
        _optional("device_type", T.StringType()),
        _optional("chapter_id", T.StringType()),
        _optional("score", T.DoubleType()),
    ]
)

# The tabular dataset in its CSV column order; readers match columns by position.
B22 = T.StructType(
    [
        _optional("record_id", T.StringType()),
        _optional("student_id", T.StringType()),
        _optional("student_name", T.StringType()),
        _optional("student_major", T.StringType()),
        _optional("course_id", T.StringType()),
        _optional("course_name", T.StringType()),
        _optional("course_credits", T.DoubleType()),
        _optional("behavior_type", T.StringType()),
        _optional("duration", T.LongType()),
        _optional("timestamp", T.StringType()),
        _optional("date", T.StringType()),
        _optional("hour", T.IntegerType()),
        _optional("weekday", T.IntegerType()),
        _optional("week_number", T.IntegerType()),
        _optional("ip_address", T.StringType()),
        _optional("device_type", T.StringType()),
        _optional("browser", T.StringType()),
        _optional("os", T.StringType()),
        _optional("chapter_id", T.StringType()),
        _optional("score", T.DoubleType()),
        _optional("is_weekend", T.IntegerType()),
        _optional("is_exam_week", T.IntegerType()),
    ]
)

CORRUPT = "_corrupt_record"

# Everything a landing folder may hold: B8 and B11 files side by side.
LOG = T.StructType(
    [_optional(f.name, f.dataType) for f in B8]
    + [f for f in B11 if f.name not in B8.fieldNames()]
)
LOG_WITH_CORRUPT = T.StructType(LOG.fields + [_optional(CORRUPT, T.StringType())])

B8_COLUMNS = B8.fieldNames()
REQUIRED_FIELDS = B11.fieldNames()
BUSINESS_KEY = ["student_id", "course_id", "timestamp", "behavior_type"]

# ---------------------------------------------------------------------------
# Codes, labels, thresholds and weights that results depend on.
# ---------------------------------------------------------------------------
BEHAVIORS = ["video_watch", "homework_submit", "quiz_complete", "forum_post", "material_download"]
BEHAVIOR_LABELS = {
    "video_watch": "视频观看",
    "homework_submit": "作业提交",
    "quiz_complete": "测验完成",
    "forum_post": "论坛发帖",
    "material_download": "资料下载",
}
BEHAVIOR_WEIGHTS = [
    ("video_watch", 45),
    ("homework_submit", 15),
    ("quiz_complete", 20),
    ("forum_post", 10),
    ("material_download", 10),
]
SCORED_BEHAVIORS = ["quiz_complete", "homework_submit"]
DEVICES = ["PC", "Mobile", "Tablet"]
DEVICE_WEIGHTS = [("PC", 40), ("Mobile", 45), ("Tablet", 15)]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge", "MicroMessenger"]
OPERATING_SYSTEMS = ["Windows 10", "Windows 11", "macOS", "iOS", "Android", "Ubuntu"]
MAJORS = ["计算机科学与技术", "软件工程", "数据科学", "人工智能", "网络工程"]
CAMPUS_IP_PREFIXES = ["10.1.", "10.2.", "10.3.", "192.168.1.", "192.168.2."]
# (course_id, course_name, chapters, credits)
COURSES = [
    ("COURSE_001", "大数据技术基础", 12, 3.0),
    ("COURSE_002", "Python程序设计", 15, 4.0),
    ("COURSE_003", "数据库原理", 10, 3.0),
    ("COURSE_004", "机器学习导论", 14, 4.0),
    ("COURSE_005", "云计算技术", 11, 3.0),
    ("COURSE_006", "数据挖掘", 13, 3.0),
    ("COURSE_007", "分布式系统", 9, 2.0),
    ("COURSE_008", "人工智能基础", 16, 4.0),
]
# Seconds per behaviour, [low, high): the batch generator's uniform draw.
BATCH_DURATIONS = {
    "video_watch": (300, 3600),
    "homework_submit": (1800, 7200),
    "quiz_complete": (600, 1800),
    "forum_post": (120, 600),
    "material_download": (60, 300),
}
# Seconds per behaviour, [low, high]: the log generator's uniform draw.
LOG_DURATIONS = {
    "video_watch": (300, 3600),
    "homework_submit": (600, 7200),
    "quiz_complete": (300, 1800),
    "forum_post": (60, 600),
    "material_download": (10, 120),
}
# Seconds per behaviour, (low, high, mode): the dataset generator's triangular draw.
TRIANGULAR_DURATIONS = {
    "video_watch": (300, 7200, 2400),
    "homework_submit": (900, 14400, 5400),
    "quiz_complete": (300, 3600, 1800),
    "forum_post": (60, 1800, 300),
    "material_download": (10, 300, 60),
}
# Seconds of a behaviour that has no range of its own.
LOG_DURATION_DEFAULT = (60, 600)
DATASET_DURATION_DEFAULT = (60, 3600)
TERM_WEEKS = 16
EXAM_WEEKS = (15, 16)
# Acceptance weight per hour of day, out of 4.0; hours not listed weigh 1.0.
WEEKDAY_HOUR_WEIGHTS = [((8, 11), 3.0), ((14, 17), 2.5), ((19, 22), 3.5), ((0, 6), 0.1)]
WEEKEND_HOUR_WEIGHTS = [((9, 23), 1.8), ((0, 7), 0.3)]
EXAM_WEEK_FACTOR = 1.5
ROSTER_SIZE = 50
INACTIVE_DAYS = 7
INACTIVE_LEVELS = [(14, "高"), (10, "中")]
INACTIVE_LEVEL_DEFAULT = "低"
LOW_DURATION_SECONDS = 1800
LOW_SCORE = 60
BATCH_ALERT_MESSAGE = "学习时长仅 %s 小时，低于平均水平"
REALTIME_ALERT_MESSAGE = "学习时长仅 %s 小时"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
IP_PATTERN = r"^192\.168\.\d{1,3}\.\d{1,3}$"
STUDENT_PREFIX = "STU_"
COURSE_PREFIX = "COURSE_"
INGEST_TIME_ZONE = "Asia/Shanghai"
MAX_LINE_LENGTH = 10240
LOG_COMPONENTS = {
    "hadoop": ["HDFS", "YARN"],
    "spark": ["Spark"],
    "web": ["Web"],
    "flume": ["Flume"],
}
