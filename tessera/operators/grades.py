"""Grade analytics over a flat fact table.

Input shape (one row per course grade):
``student_id, name, major, year, course_name, score, seq`` with ``seq`` the
unique input order. Students are ordered by their first row, courses of a
student by ``seq`` — the iteration order of the source, which decides ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import (LETTER_BANDS, LETTER_FLOOR, exact_sum, half_even_mean,
                                       letter_grade)
from tessera.operators.ordering import (DEFAULT_CHUNK, join_keys_null_safe,
                                        position_in_key, trailing_mean_in_key)

DEFAULT_TOP_N = 3
DEFAULT_WINDOW = 3


def with_letter_grade(grades: DataFrame, score: str = "score", out: str = "category",
                      bands=LETTER_BANDS, floor_label=LETTER_FLOOR) -> DataFrame:
    """Letter grade from configurable lower bounds."""
    return grades.withColumn(out, letter_grade(F.col(score), bands, floor_label))


def student_dimension(grades: DataFrame) -> DataFrame:
    """One row per student; name/major/year from the student's first row.

    Columns: student_id, first_seq, name, major, year, n_courses.
    """
    first = F.min_by(F.struct("name", "major", "year"), F.col("seq"))
    return grades.groupBy("student_id").agg(first.alias("__first"), F.min("seq").alias("first_seq"),
                                             F.count(F.lit(1)).alias("n_courses")) \
        .select("student_id", "first_seq", "__first.name", "__first.major", "__first.year", "n_courses")


def grade_distribution(grades: DataFrame) -> DataFrame:
    """A1: number of grades per letter (absent letters omitted)."""
    g = grades if "category" in grades.columns else with_letter_grade(grades)
    return g.groupBy("category").agg(F.count(F.lit(1)).alias("n_grades"))


def grade_mode(grades: DataFrame) -> DataFrame:
    """A2: most common letter; ties go to the letter met first in
    student-then-course order; ``N/A`` when there are no grades. One row."""
    g = grades if "category" in grades.columns else with_letter_grade(grades)
    # per (student, letter): count and first row; a student's first row is the
    # smallest of these, found by a window holding at most one row per letter
    per_sl = g.groupBy("student_id", "category").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq"))
    per_sl = per_sl.withColumn("student_seq", F.min("seq").over(Window.partitionBy("student_id")))
    per_cat = per_sl.groupBy("category").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("student_seq", "seq")).alias("first_seen"))
    # Global aggregate over at most one row per letter: always exactly one row.
    best = per_cat.agg(F.max_by(F.col("category"), F.struct(
        F.col("n"), (-F.col("first_seen.student_seq")).alias("a"),
        (-F.col("first_seen.seq")).alias("b"))).alias("mode"))
    return best.select(F.coalesce(F.col("mode"), F.lit("N/A")).alias("mode"))


def major_grouping(grades: DataFrame, chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """A3: student names per major in first-seen student order, flat:
    (major, position, student_id, name). Duplicate names are kept."""
    dim = student_dimension(grades)
    ranked = position_in_key(dim, "major", "first_seq", "position", chunk_width)
    return ranked.select("major", "position", "student_id", "name")


def student_averages(grades: DataFrame) -> DataFrame:
    """A4: per-student average over all its grades, rounded to 2 (half-even).
    Columns: student_id, name, first_seq, average_score."""
    out = grades.groupBy("student_id").agg(
        exact_sum(F.col("score")).alias("__s"), F.count("score").alias("__n"),
        F.min_by(F.col("name"), F.col("seq")).alias("name"), F.min("seq").alias("first_seq"))
    return out.select("student_id", "name", "first_seq",
                      F.coalesce(half_even_mean(F.col("__s"), F.col("__n")), F.lit(0.0))
                      .alias("average_score"))


def overall_average(grades: DataFrame) -> DataFrame:
    """A5: mean over all grades (not of student means), rounded 2; 0.0 if empty."""
    return grades.agg(F.coalesce(
        half_even_mean(exact_sum(F.col("score")), F.count("score")), F.lit(0.0)
    ).alias("overall_average"))


def course_best_grade(grades: DataFrame, course_name: str | None = None) -> DataFrame:
    """Highest grade per course; the first row (in student-then-course
    order) wins ties. Optional course filter; unknown course gives no row."""
    g = grades if "category" in grades.columns else with_letter_grade(grades)
    if course_name is not None:
        g = g.filter(F.col("course_name") == F.lit(course_name))
    # best row per (student, course) first (ties: earliest row), so the join
    # with each student's first row runs on that aggregate, not on every grade
    per_sc = g.groupBy("student_id", "course_name").agg(F.max_by(
        F.struct("score", "category", "seq"), F.struct(F.col("score"), (-F.col("seq")).alias("b"))).alias("top"))
    per_sc = per_sc.select("student_id", "course_name", "top.*")
    firsts = grades.groupBy("student_id").agg(F.min("seq").alias("student_seq"))
    ranked = join_keys_null_safe(per_sc, firsts, ["student_id"], "left")
    best = ranked.groupBy("course_name").agg(F.max_by(
        F.struct("student_id", "score", "category"),
        F.struct(F.col("score"), (-F.col("student_seq")).alias("a"), (-F.col("seq")).alias("b"))
    ).alias("best"))
    return best.select("course_name", F.col("best.student_id").alias("student_id"),
                       F.col("best.score").alias("score"), F.col("best.category").alias("category"))


def top_performers(grades: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """The n best students by rounded average; ties keep first-seen order.
    A top-k: one bounded ``TakeOrderedAndProject``."""
    avgs = student_averages(grades)
    order = [F.col("average_score").desc(), F.col("first_seq").asc()]
    top = avgs.orderBy(*order).limit(n)
    # The window below sees at most n rows (after the limit).
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
                      "student_id", "name", "average_score")


def rolling_averages(grades: DataFrame, window_size: int = DEFAULT_WINDOW,
                     chunk_width: int = DEFAULT_CHUNK) -> DataFrame:
    """Per student, in input order, mean of the current and previous
    ``window_size - 1`` grades, rounded 2. Keyed by student_id (names can
    repeat). Columns: student_id, name, position, rolling_average."""
    out = trailing_mean_in_key(grades.select("student_id", "name", "score", "seq"), "student_id", "seq", "score",
                               window_size, "rolling_average", "position", chunk_width)
    return out.select("student_id", "name", "position", "rolling_average")


def total_students(grades: DataFrame) -> DataFrame:
    """Distinct students."""
    return grades.agg(F.countDistinct("student_id").alias("total_students"))


def report_rows(grades: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """A7 flat: (section, key, value) with the total, the distribution by
    letter, the mode, the top performers by rank and the overall average."""
    g = with_letter_grade(grades)

    def rows(df, section, key, value):
        return df.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key") if key else F.lit("").alias("key"),
                         F.col(value).cast("string").alias("value"))

    top = top_performers(g, top_n).withColumn("__who", F.concat_ws(" ", "name", F.col("average_score").cast("string")))
    return rows(total_students(g), "total_students", None, "total_students") \
        .unionByName(rows(grade_distribution(g), "grade_distribution", "category", "n_grades")) \
        .unionByName(rows(grade_mode(g), "mode", None, "mode")) \
        .unionByName(rows(top, "top_performers", "rank", "__who")) \
        .unionByName(rows(overall_average(g), "overall_average", None, "overall_average"))


def grade_report(grades: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """The bounded part of the analytics report as one row: total
    students, letter distribution (<= 5 entries), mode, top-n performers and
    overall average. The unbounded sections (names per major, rolling
    averages) stay distributed tables — see ``sources.sinks.write_grade_report``."""
    g = with_letter_grade(grades)
    dist = grade_distribution(g).agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("category", "n_grades")))).alias("grade_distribution"))
    top = top_performers(g, top_n).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "name", "average_score"))),
        lambda t: F.struct(t["name"].alias("name"), t["average_score"].alias("average_score")),
    ).alias("top_performers"))
    parts = [total_students(g), dist, grade_mode(g), top, overall_average(g)]
    # every part is one row by definition, so the others are broadcast beside the first
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))
    return out
