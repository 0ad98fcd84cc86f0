import random

import pytest

from tessera.operators import academics as S

STUDENTS = "seq long, student_id string, name string, gender string, email string, level string, field string"
COURSES = "seq long, course_id string, title string, allowed_levels string, allowed_fields string"
PAIRS = "seq long, student_id string, course_id string"
CHANGES = "seq long, student_id string, course_id string, grade double"

LEVEL_LISTS = [None, "undergraduate", "graduate", "undergraduate, graduate"]
FIELD_LISTS = [None, "science", "arts, law", " medicine ,engineering", "commerce,science"]
FIELDS = ["science", "arts", "commerce", "engineering", "medicine", "law"]


def sequential(students, courses, requests, changes):
    """Plain in-order model of enrolment, grade changes and averages."""
    st = {}
    for seq, sid, *_, level, field in sorted(students):
        st.setdefault(sid, (level, field))
    co = {}
    for seq, cid, _, levels, fields in sorted(courses):
        lv = ["undergraduate", "graduate"] if levels is None else [t.strip() for t in levels.split(",")]
        fd = FIELDS if fields is None else [t.strip() for t in fields.split(",")]
        co.setdefault(cid, (lv, fd))
    enrolled, outcomes = {}, {}
    for seq, sid, cid in sorted(requests):
        if sid not in st:
            outcomes[seq] = "unknown_student"
        elif cid not in co:
            outcomes[seq] = "unknown_course"
        elif st[sid][0] not in co[cid][0]:
            outcomes[seq] = "level_not_allowed"
        elif st[sid][1] not in co[cid][1]:
            outcomes[seq] = "field_not_allowed"
        elif (sid, cid) in enrolled:
            outcomes[seq] = "already_enrolled"
        else:
            enrolled[(sid, cid)] = None
            outcomes[seq] = "enrolled"
    applied = {}
    for seq, sid, cid, g in sorted(changes):
        if (sid, cid) not in enrolled:
            applied[seq] = "not_enrolled"
        elif not 0 <= g <= 100:
            applied[seq] = "out_of_range"
        else:
            enrolled[(sid, cid)] = g
            applied[seq] = "applied"
    averages = {}
    for sid in st:
        gs = [g for (s, _), g in enrolled.items() if s == sid and g is not None]
        averages[sid] = sum(gs) / len(gs) if gs else 0.0
    return outcomes, applied, enrolled, averages


@pytest.mark.parametrize("seed", [7, 8])
def test_enrolment_grades_and_averages_match_sequential(spark, seed):
    rnd = random.Random(seed)
    students = [(i, f"s{i % 9}", "Ann Lee", "female", "a@b.c", rnd.choice(["undergraduate", "graduate"]),
                 rnd.choice(FIELDS)) for i in range(12)]          # repeated ids: the first one counts
    courses = [(i, f"c{i % 5}", "Maths", rnd.choice(LEVEL_LISTS), rnd.choice(FIELD_LISTS)) for i in range(6)]
    ids = [f"s{i}" for i in range(11)]                             # s9, s10 are unknown students
    cids = [f"c{i}" for i in range(6)]                             # c5 is an unknown course
    requests = [(s, rnd.choice(ids[:3]) if rnd.random() < 0.5 else rnd.choice(ids), rnd.choice(cids))
                for s in rnd.sample(range(10_000), 150)]           # a few hot (student, course) pairs
    changes = [(s, rnd.choice(ids), rnd.choice(cids), float(rnd.choice([-5, 0, 40, 75, 100, 101, 88])))
               for s in rnd.sample(range(10_000, 20_000), 200)]
    want_out, want_applied, want_grades, want_avg = sequential(students, courses, requests, changes)

    st = S.validate_students(spark.createDataFrame(students, STUDENTS))
    co = S.validate_courses(spark.createDataFrame(courses, COURSES))
    en = S.enroll(spark.createDataFrame(requests, PAIRS), st, co)
    assert {r["seq"]: r["outcome"] for r in en.collect()} == want_out
    pairs = S.enrolled_pairs(spark.createDataFrame(requests, PAIRS), st, co)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, S.enrolments(en).collect()))
    ch, graded = S.apply_grades(spark.createDataFrame(changes, CHANGES), S.enrolments(en))
    assert {r["seq"]: r["outcome"] for r in ch.collect()} == want_applied
    assert {(r["student_id"], r["course_id"]): r["grade"] for r in graded.collect()} == want_grades
    avg = {r["student_id"]: r["average"] for r in S.transcript_average(graded, st).collect()}
    assert avg.keys() == want_avg.keys()
    assert all(abs(avg[k] - want_avg[k]) < 1e-9 for k in avg)
