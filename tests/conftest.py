import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coursepulse import schema as S  # noqa: E402
from coursepulse.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


def record(i=0, student="STU_1", name="Ann", course="COURSE_001", behavior="video_watch",
           duration=60, ts="2024-01-10 08:00:00", **more):
    row = {
        "record_id": f"r{i:06d}",
        "student_id": student,
        "student_name": name,
        "course_id": course,
        "course_name": f"{course} name",
        "behavior_type": behavior,
        "duration": duration,
        "timestamp": ts,
        "ip_address": "192.168.1.2",
        "device_type": "PC",
        "chapter_id": "CH_001",
        "score": None,
    }
    row.update(more)
    return row


def frame(spark, rows):
    columns = S.LOG.fieldNames()
    return spark.createDataFrame([[r[c] for c in columns] for r in rows], S.LOG)


def random_log(n, seed, students=7, courses=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        behavior = rng.choice(S.BEHAVIORS)
        student = rng.randrange(students)
        scored = behavior in S.SCORED_BEHAVIORS and rng.random() < 0.9
        rows.append(
            record(
                i,
                student=f"STU_{student}",
                name=f"name {student}",
                course=f"COURSE_{rng.randrange(courses):03d}",
                behavior=behavior,
                duration=rng.randrange(1, 7200),
                ts=f"2024-01-{rng.randrange(1, 31):02d} {rng.randrange(24):02d}:"
                f"{rng.randrange(60):02d}:{rng.randrange(60):02d}",
                device_type=rng.choice(S.DEVICES),
                score=round(rng.uniform(0, 100), 1) if scored else None,
            )
        )
    return rows


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def as_set(df):
    return sorted(map(repr, rows_of(df)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
