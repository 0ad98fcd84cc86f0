"""Registered academic-records queries and SQL oracles."""

from __future__ import annotations

from tessera.operators import academics as S
from tessera.plans.sqlfrag import half_even_mean, py_blank, py_strip
from tessera.plans.tables import view, with_views


def _students(spark, sf):
    return S.validate_students(view(spark, sf, "students_v"))


def _courses(spark, sf):
    return S.validate_courses(view(spark, sf, "courses_v"))


def _ctx(spark, sf):
    """Validated students / courses, enrolment outcomes and graded enrolments.

    Each registered query uses these once, through a plan a few stages deep,
    so nothing is materialised: writing and re-reading them costs more than
    the recomputation (measured), and a lost executor only re-runs the
    missing shuffle outputs."""
    st = _students(spark, sf)
    co = _courses(spark, sf)
    requests = view(spark, sf, "enroll_requests_v")
    en = S.enroll(requests, st, co)
    changes, graded = S.apply_grades(view(spark, sf, "grade_changes_v"), S.enrolled_pairs(requests, st, co))
    return st, co, en, changes, graded


def _enrol(spark, sf):
    return _ctx(spark, sf)[2]


QUERIES = {
    "student_validate": lambda spark, sf: _students(spark, sf).select("seq", "student_id", "gender", "error_code"),
    "course_validate": lambda spark, sf: _courses(spark, sf).select("seq", "course_id", "error_code"),
    "enroll_outcome": _enrol,
    "grade_apply": lambda spark, sf: _ctx(spark, sf)[3].select("seq", "student_id", "course_id", "grade",
                                                                "outcome"),
    "transcript": lambda spark, sf: (lambda c: S.transcript(c[4], c[1]))(_ctx(spark, sf)),
    "transcript_average": lambda spark, sf: (lambda c: S.transcript_average(c[4], c[0]))(_ctx(spark, sf)),
    "course_roster": lambda spark, sf: (lambda c: S.course_roster(c[4], c[0]))(_ctx(spark, sf)),
    "enrolment_counts": lambda spark, sf: (lambda c: S.enrolment_counts(c[4], c[1]))(_ctx(spark, sf)),
    "unenroll_outcome": lambda spark, sf: (lambda c: S.unenroll(view(spark, sf, "unenroll_requests_v"), c[4],
                                                                c[0], c[1]))(_ctx(spark, sf)),
    "unenroll_remaining": lambda spark, sf: (lambda c: S.remaining_enrolments(
        c[4], S.unenroll(view(spark, sf, "unenroll_requests_v"), c[4], c[0], c[1])))(_ctx(spark, sf))
    .select("student_id", "course_id", "grade"),
    "course_titles": lambda spark, sf: S.course_title_updates(view(spark, sf, "course_changes_v"),
                                                              _courses(spark, sf))[1].select("seq", "course_id", "title"),
    "course_update": lambda spark, sf: S.course_title_updates(view(spark, sf, "course_changes_v"),
                                                              _courses(spark, sf))[0],
    "course_average": lambda spark, sf: S.course_average(_ctx(spark, sf)[4]),
    "student_listing": lambda spark, sf: S.listing(_students(spark, sf), ["student_id", "name", "level", "field"]),
    "course_listing": lambda spark, sf: S.listing(_courses(spark, sf), ["course_id", "title"]),
}

_LETTERS = lambda c: f"coalesce(regexp_matches({c}, '^ *\\p{{L}}[\\p{{L}} ]*\\z'), false)"
_LV = "['undergraduate', 'graduate']"
_FD = "['science', 'arts', 'commerce', 'engineering', 'medicine', 'law']"


def _toks(c: str, default: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN {default} ELSE list_transform(string_split({c}, ','), lambda t: {py_strip('t')}) END"


_SC = f"""sv AS (SELECT seq, student_id, name, lower(gender) AS gender, email, level, field,
  CASE WHEN level IS NULL OR level NOT IN ('undergraduate', 'graduate') THEN 'invalid_level'
       WHEN field IS NULL OR field NOT IN ('science', 'arts', 'commerce', 'engineering', 'medicine', 'law')
         THEN 'invalid_field'
       WHEN {py_blank('name')} THEN 'missing_name' WHEN NOT {_LETTERS('name')} THEN 'invalid_name'
       WHEN {py_blank('student_id')} THEN 'missing_id'
       WHEN lower(gender) IS NULL OR lower(gender) NOT IN ('male', 'female') THEN 'invalid_gender'
       WHEN NOT coalesce(contains(email, '@') AND contains(email, '.'), false) THEN 'invalid_email' END AS rest
  FROM students_v),
st AS (SELECT *, CASE WHEN seq > min(CASE WHEN rest IS NULL THEN seq END) OVER (PARTITION BY student_id)
                      THEN 'duplicate_id' ELSE rest END AS error_code FROM sv),
cp AS (SELECT *, {_toks('allowed_levels', _LV)} AS levels, {_toks('allowed_fields', _FD)} AS fields FROM courses_v),
cv AS (SELECT *, CASE WHEN NOT list_bool_and(list_transform(levels, lambda t: t IN ('undergraduate', 'graduate')))
         THEN 'invalid_level'
       WHEN NOT list_bool_and(list_transform(fields, lambda t:
              t IN ('science', 'arts', 'commerce', 'engineering', 'medicine', 'law'))) THEN 'invalid_field'
       WHEN {py_blank('title')} THEN 'missing_title' WHEN NOT {_LETTERS('title')} THEN 'invalid_title' END AS rest
  FROM cp),
co AS (SELECT *, CASE WHEN seq > min(CASE WHEN rest IS NULL THEN seq END) OVER (PARTITION BY course_id)
                      THEN 'duplicate_id' ELSE rest END AS error_code FROM cv),
vs AS (SELECT * FROM st WHERE error_code IS NULL),
vc AS (SELECT * FROM co WHERE error_code IS NULL),
rq AS (SELECT r.seq, r.student_id, r.course_id,
         CASE WHEN vs.student_id IS NULL THEN 'unknown_student' WHEN vc.course_id IS NULL THEN 'unknown_course'
              WHEN NOT list_contains(vc.levels, vs.level) THEN 'level_not_allowed'
              WHEN NOT list_contains(vc.fields, vs.field) THEN 'field_not_allowed' END AS pre
       FROM enroll_requests_v r LEFT JOIN vs ON r.student_id = vs.student_id
       LEFT JOIN vc ON r.course_id = vc.course_id),
eo AS (SELECT seq, student_id, course_id, coalesce(pre, CASE WHEN seq = min(CASE WHEN pre IS NULL THEN seq END)
         OVER (PARTITION BY student_id, course_id) THEN 'enrolled' ELSE 'already_enrolled' END) AS outcome FROM rq),
en AS (SELECT seq, student_id, course_id FROM eo WHERE outcome = 'enrolled'),
gc AS (SELECT g.seq, g.student_id, g.course_id, g.grade,
         CASE WHEN en.seq IS NULL THEN 'not_enrolled' WHEN g.grade < 0 OR g.grade > 100 THEN 'out_of_range'
              ELSE 'applied' END AS outcome
       FROM grade_changes_v g LEFT JOIN en ON g.student_id = en.student_id AND g.course_id = en.course_id),
lg AS (SELECT student_id AS ls, course_id AS lc, arg_max(grade, seq) AS grade FROM gc WHERE outcome = 'applied'
       GROUP BY student_id, course_id),
gr AS (SELECT en.seq, en.student_id, en.course_id, lg.grade FROM en
       LEFT JOIN lg ON en.student_id = lg.ls AND en.course_id = lg.lc)"""

_VIEWS = ("students_v", "courses_v", "enroll_requests_v", "grade_changes_v")

ORACLE = {
    "student_validate": with_views(f", {_SC} SELECT seq, student_id, gender, error_code FROM st", *_VIEWS),
    "course_validate": with_views(f", {_SC} SELECT seq, course_id, error_code FROM co", *_VIEWS),
    "enroll_outcome": with_views(f", {_SC} SELECT * FROM eo", *_VIEWS),
    "grade_apply": with_views(f", {_SC} SELECT * FROM gc", *_VIEWS),
    "transcript": with_views(f""", {_SC}
SELECT gr.student_id, gr.course_id, vc.seq AS course_seq, vc.title, gr.grade,
       CASE WHEN gr.grade IS NULL THEN 'Not graded' ELSE 'Graded' END AS grade_note
FROM gr JOIN vc ON gr.course_id = vc.course_id""", *_VIEWS),
    "transcript_average": with_views(f""", {_SC},
a AS (SELECT student_id AS sid, sum(grade) AS s, count(grade) AS n FROM gr GROUP BY student_id),
b AS (SELECT vs.student_id, vs.name, CASE WHEN coalesce(a.n, 0) > 0 THEN a.s / a.n ELSE 0.0 END AS average
      FROM vs LEFT JOIN a ON vs.student_id = a.sid)
SELECT student_id, name, average, CASE WHEN average >= 80 THEN 'First Class' WHEN average >= 70 THEN 'Second Upper Class'
  WHEN average >= 60 THEN 'Second Lower Class' WHEN average >= 50 THEN 'Pass' ELSE 'Fail' END AS academic_status
FROM b""", *_VIEWS),
    "course_roster": with_views(f""", {_SC}
SELECT gr.course_id, CAST(row_number() OVER (PARTITION BY gr.course_id ORDER BY gr.seq) AS BIGINT) AS position,
       gr.student_id, vs.level, vs.field, gr.grade FROM gr LEFT JOIN vs ON gr.student_id = vs.student_id""", *_VIEWS),
    "enrolment_counts": with_views(f""", {_SC}
SELECT vc.course_id, vc.title, CAST(coalesce(n.k, 0) AS BIGINT) AS n_enrolled FROM vc
LEFT JOIN (SELECT course_id, count(*) AS k FROM gr GROUP BY course_id) n ON vc.course_id = n.course_id""", *_VIEWS),
    "unenroll_outcome": with_views(f""", {_SC}
SELECT u.seq, u.student_id, u.course_id,
  CASE WHEN vs.student_id IS NULL OR vc.course_id IS NULL THEN 'not_found'
       WHEN gr.seq IS NOT NULL AND u.seq = min(u.seq) OVER (PARTITION BY u.student_id, u.course_id) THEN 'removed'
       ELSE 'not_enrolled' END AS outcome
FROM unenroll_requests_v u LEFT JOIN vs ON u.student_id = vs.student_id LEFT JOIN vc ON u.course_id = vc.course_id
LEFT JOIN gr ON u.student_id = gr.student_id AND u.course_id = gr.course_id""", *_VIEWS, "unenroll_requests_v"),
    "unenroll_remaining": with_views(f""", {_SC}
SELECT student_id, course_id, grade FROM gr WHERE (student_id, course_id) NOT IN (
  SELECT (u.student_id, u.course_id) FROM unenroll_requests_v u JOIN vs ON u.student_id = vs.student_id
  JOIN vc ON u.course_id = vc.course_id)""", *_VIEWS, "unenroll_requests_v"),
    "course_titles": with_views(f""", {_SC},
ch AS (SELECT course_id AS c, arg_max({py_strip('new_title')}, seq) AS t FROM course_changes_v
       WHERE NOT {py_blank('new_title')} GROUP BY course_id)
SELECT vc.seq, vc.course_id, coalesce(ch.t, vc.title) AS title FROM vc LEFT JOIN ch ON vc.course_id = ch.c""",
                                *_VIEWS, "course_changes_v"),
    "course_average": with_views(f""", {_SC}
SELECT course_id, count(grade) AS n_graded, {half_even_mean('sum(grade)', 'count(grade)')} AS average_grade
FROM gr GROUP BY course_id""", *_VIEWS),
    "student_listing": with_views(f", {_SC} SELECT seq, student_id, name, level, field FROM vs", *_VIEWS),
    "course_listing": with_views(f", {_SC} SELECT seq, course_id, title FROM vc", *_VIEWS),
    "course_update": with_views(f""", {_SC}
SELECT c.seq, c.course_id, {py_strip('c.new_title')} AS new_title,
  CASE WHEN vc.course_id IS NULL THEN 'not_found' WHEN {py_blank('c.new_title')} THEN 'skipped' ELSE 'applied' END
    AS outcome
FROM course_changes_v c LEFT JOIN vc ON c.course_id = vc.course_id""", *_VIEWS, "course_changes_v"),
}
