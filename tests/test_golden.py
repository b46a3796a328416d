"""Golden values restated from the course's small teaching files (marks, stock orders, people)."""

from pyspark.sql import functions as F

from corvid.operators import joins
from corvid.sources.files import from_local

# Marks per subject (pupil, mark) as listed in the teaching data.
FISICA = [("Angel", 9), ("Maria", 3), ("Ramon", 7), ("Jorge", 5), ("Susana", 9), ("Anabel", 2), ("Pedro", 2),
          ("Rocio", 5), ("Carlos", 4), ("Rocio", 7), ("Triana", 3), ("Andres", 4), ("Fernando", 9),
          ("Leonardo", 6), ("Oscar", 5), ("Isabel", 8), ("Jose Juan", 3), ("Nicolas", 7), ("Alejandro", 3),
          ("Rosa", 8)]
INGLES = [("Angel", 4), ("Maria", 6), ("Ramon", 8), ("Jorge", 5), ("Susana", 2), ("Anabel", 7), ("Rocio", 4),
          ("Carlos", 8), ("Triana", 4), ("Andres", 6), ("Fernando", 7), ("Leonardo", 4), ("Oscar", 3),
          ("Isabel", 7), ("Jose Juan", 3), ("Nicolas", 5), ("Alejandro", 7), ("Rosa", 9)]
MATES = [("Angel", 6), ("Maria", 2), ("Ramon", 4.5), ("Jorge", 10), ("Susana", 9), ("Anabel", 8), ("Pedro", 5),
         ("Rocio", 6), ("Carlos", 4), ("Triana", 3), ("Andres", 4), ("Fernando", 5), ("Leonardo", 1), ("Oscar", 7),
         ("Isabel", 8), ("Jose Juan", 5), ("Nicolas", 2), ("Alejandro", 5), ("Rosa", 6)]


def _marks(spark, rows):
    return from_local(spark, [(a, float(n)) for a, n in rows], "alumno string, nota double", 2)


def test_failing_marks_per_subject(spark):
    counts = [_marks(spark, s).where(F.col("nota") < 5).count() for s in (FISICA, INGLES, MATES)]
    assert counts == [8, 7, 7]


def test_three_way_join_duplicates_and_losses(spark):
    f, i, m = (_marks(spark, s).withColumnRenamed("nota", n) for s, n in
               ((FISICA, "fisica"), (INGLES, "ingles"), (MATES, "mates")))
    inner = f.join(i, "alumno").join(m, "alumno")
    pupils = [r.alumno for r in inner.collect()]
    assert pupils.count("Rocio") == 2 and "Pedro" not in pupils
    full = joins.full_outer_chain([f, i, m], "alumno")
    pedro = full.where("alumno = 'Pedro'").first()
    assert pedro.ingles is None and pedro.fisica == 2.0


def test_people_derived_columns_keep_null_age(spark):
    from corvid.functions.parse import birth_year
    people = from_local(spark, [("Aitor", 45, "Elche"), ("Marina", 14, "Alicante"), ("Laura", 19, "Elche"),
                                ("Sonia", 45, "Aspe"), ("Pedro", None, "Elche")],
                        "Nombre string, Edad long, Ciudad string")
    out = people.select("Nombre", (F.col("Edad") > 30).alias("Mayor30"), (67 - F.col("Edad")).alias("Falta"),
                        birth_year("Edad", "2024-06-30").alias("AnyoNac"))
    rows = {r.Nombre: r for r in out.collect()}
    assert rows["Pedro"].Mayor30 is None and rows["Pedro"].Falta is None
    assert rows["Aitor"].Mayor30 and rows["Marina"].Falta == 53 and rows["Laura"].AnyoNac == 2005
