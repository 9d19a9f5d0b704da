import random

from plumbline.llm.reading import fit_reading, reading_grades, words

RNG = random.Random(2)
VOCABULARY = {g: [f"{'abcd'[g - 1]}{x}{y}" for x in "klmnp" for y in "aeiou"] for g in (1, 2, 3, 4)}


def document(grade):
    """Words up to the grade, most of them its own."""
    return " ".join(RNG.choice(VOCABULARY[grade if RNG.random() < 0.6 else RNG.randint(1, grade)]) for _ in range(40))


def test_held_out_documents(spark):
    docs = [(i, document(1 + i % 4)) for i in range(240)]
    labels = [(i, f"r{r}", 1 + i % 4) for i in range(120) for r in range(2)] + [(999, "r", 2), (0, "r", None)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "9 as grade", "8 as fold", "7 as h"), spark.createDataFrame(labels, "doc_id long, rater string, grade long")
    model = fit_reading(d, "doc_id", "text", lab, "grade")
    got = {r.doc_id: r.grade for r in reading_grades(d, "doc_id", "text", model).collect()}
    held_out = [i for i in range(120, 240)]
    assert sum(got[i] == 1 + i % 4 for i in held_out) / len(held_out) > 0.95


def test_texts_without_grades(spark):
    docs = [(i, document(1 + i % 4)) for i in range(60)] + [(70, None), (71, ""), (72, "see above"), (73, "xx yy zz " * 30), (74, document(4) * 500)]
    lab = spark.createDataFrame([(i, 1 + i % 4) for i in range(60)], "doc_id long, grade long")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.grade for r in reading_grades(d, "doc_id", "text", fit_reading(d, "doc_id", "text", lab, "grade")).collect()}
    assert [got[i] for i in (70, 71, 72, 73)] == [None] * 4 and got[74] == 4


def test_too_few_grades(spark):
    d, lab = spark.createDataFrame([(1, document(1)), (2, document(1))], "doc_id long, text string"), spark.createDataFrame([(1, 1)], "doc_id long, grade long")
    for labels in (lab, lab.limit(0)):
        model = fit_reading(d, "doc_id", "text", labels, "grade")
        assert [r.grade for r in reading_grades(d, "doc_id", "text", model).collect()] == [None, None]
    assert reading_grades(d.limit(0), "doc_id", "text", model).count() == 0


def test_words():
    assert words("Der Hund <b>läuft</b> 3 mal") == ["der", "hund", "läuft", "mal"] and words("小猫跑") == ["小猫", "猫跑"] and words("") == []


def test_texts_of_mostly_unknown_words_get_a_grade(spark):
    known = "aa ab ac ad ae af"
    docs = [(i, known if i % 2 else "za zb zc zd ze zf") for i in range(20)] + [(90, known + " " + " ".join(f"q{c}" for c in "abcdefghijklmnopqrst")), (91, "aa ab qa")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 4 if i % 2 else 1) for i in range(20)], "doc_id long, grade long")
    got = {r.doc_id: r for r in reading_grades(df, "doc_id", "text", fit_reading(df, "doc_id", "text", labels, "grade")).collect()}
    assert got[90].grade == 4 and got[90].known_share < 0.3 and got[91].grade is None
