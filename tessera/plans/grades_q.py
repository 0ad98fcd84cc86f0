"""Registered grade-analytics queries and their SQL oracles."""

from __future__ import annotations

from tessera.operators import grades as G
from tessera.plans.sqlfrag import LETTER_SQL, half_even_mean
from tessera.plans.tables import view, with_views


def _g(spark, sf):
    return view(spark, sf, "grades_v")


QUERIES = {
    "letter_grade": lambda spark, sf: G.with_letter_grade(_g(spark, sf))
    .select("seq", "student_id", "score", "category"),
    "student_dim_first_wins": lambda spark, sf: G.student_dimension(_g(spark, sf)),
    "grade_distribution": lambda spark, sf: G.grade_distribution(_g(spark, sf)),
    "grade_mode": lambda spark, sf: G.grade_mode(_g(spark, sf)),
    "major_grouping": lambda spark, sf: G.major_grouping(_g(spark, sf)),
    "student_average": lambda spark, sf: G.student_averages(_g(spark, sf))
    .select("student_id", "name", "average_score"),
    "overall_average": lambda spark, sf: G.overall_average(_g(spark, sf)),
    "course_best_grade": lambda spark, sf: G.course_best_grade(_g(spark, sf)),
    "top_performers": lambda spark, sf: G.top_performers(_g(spark, sf)),
    "rolling_average": lambda spark, sf: G.rolling_averages(_g(spark, sf)),
    "total_students": lambda spark, sf: G.total_students(_g(spark, sf)),
    "grade_report": lambda spark, sf: G.report_rows(_g(spark, sf)),
}

_ORDERED = f"""g AS (SELECT *, {LETTER_SQL} AS category,
       min(seq) OVER (PARTITION BY student_id) AS student_seq FROM grades_v)"""

_AVGS = f"""a AS (SELECT student_id, arg_min(name, seq) AS name, min(seq) AS first_seq,
       {half_even_mean('sum(score)', 'count(score)')} AS average_score
  FROM grades_v GROUP BY student_id)"""

_REPORT = f"""SELECT 'total_students' AS section, '' AS key, CAST(count(DISTINCT student_id) AS VARCHAR) AS value FROM grades_v
UNION ALL SELECT 'grade_distribution', category, CAST(count(*) AS VARCHAR) FROM g GROUP BY category
UNION ALL SELECT 'mode', '', coalesce((SELECT category FROM (SELECT category, count(*) AS n, arg_min(category, (student_seq, seq)) AS c,
  min((student_seq, seq)) AS f FROM g GROUP BY category) ORDER BY n DESC, f LIMIT 1), 'N/A')
UNION ALL SELECT 'top_performers', CAST(rank AS VARCHAR), concat(name, ' ', CAST(average_score AS VARCHAR)) FROM (
  SELECT row_number() OVER (ORDER BY average_score DESC, first_seq) AS rank, name, average_score FROM a) WHERE rank <= 3
UNION ALL SELECT 'overall_average', '', CAST(coalesce({half_even_mean('sum(score)', 'count(score)')}, 0.0) AS VARCHAR) FROM grades_v"""

ORACLE = {
    "total_students": with_views("SELECT count(DISTINCT student_id) AS total_students FROM grades_v", "grades_v"),
    "grade_report": with_views(f", {_ORDERED}, {_AVGS} {_REPORT}", "grades_v"),
    "letter_grade": with_views(f"SELECT seq, student_id, score, {LETTER_SQL} AS category FROM grades_v",
                               "grades_v"),
    "student_dim_first_wins": with_views("""
SELECT student_id, min(seq) AS first_seq, arg_min(name, seq) AS name, arg_min(major, seq) AS major,
       arg_min(year, seq) AS year, count(*) AS n_courses
FROM grades_v GROUP BY student_id""", "grades_v"),
    "grade_distribution": with_views(f"""
SELECT {LETTER_SQL} AS category, count(*) AS n_grades FROM grades_v GROUP BY 1""", "grades_v"),
    "grade_mode": with_views(f""", {_ORDERED},
f AS (SELECT category, student_seq, seq,
             row_number() OVER (PARTITION BY category ORDER BY student_seq, seq) AS rn,
             count(*) OVER (PARTITION BY category) AS n FROM g)
SELECT coalesce((SELECT category FROM f WHERE rn = 1 ORDER BY n DESC, student_seq, seq LIMIT 1),
                'N/A') AS mode""", "grades_v"),
    "major_grouping": with_views("""
, d AS (SELECT student_id, min(seq) AS first_seq, arg_min(name, seq) AS name,
               arg_min(major, seq) AS major FROM grades_v GROUP BY student_id)
SELECT major, CAST(row_number() OVER (PARTITION BY major ORDER BY first_seq) AS BIGINT) AS position,
       student_id, name FROM d""", "grades_v"),
    "student_average": with_views(f", {_AVGS} SELECT student_id, name, average_score FROM a",
                                  "grades_v"),
    "overall_average": with_views(f"""
SELECT coalesce({half_even_mean('sum(score)', 'count(score)')}, 0.0) AS overall_average
FROM grades_v""", "grades_v"),
    "course_best_grade": with_views(f""", {_ORDERED}
SELECT course_name, student_id, score, category FROM (
  SELECT *, row_number() OVER (PARTITION BY course_name ORDER BY score DESC, student_seq, seq) AS rn
  FROM g) WHERE rn = 1""", "grades_v"),
    "top_performers": with_views(f""", {_AVGS}
SELECT CAST(row_number() OVER (ORDER BY average_score DESC, first_seq) AS BIGINT) AS rank,
       student_id, name, average_score
FROM a ORDER BY average_score DESC, first_seq LIMIT 3""", "grades_v"),
    "rolling_average": with_views(f"""
SELECT student_id, name,
       CAST(row_number() OVER (PARTITION BY student_id ORDER BY seq) AS BIGINT) AS position,
       {half_even_mean('sum(score) OVER w', 'count(score) OVER w')} AS rolling_average
FROM grades_v
WINDOW w AS (PARTITION BY student_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
                                  "grades_v"),
}
