"""The training draw with a large group of copies."""

from pyspark.sql import functions as F

from tenderlens.llm import language

SCHEMA = "doc_id bigint, text string, lang string"


def test_copies_leave_other_languages_their_rows(spark):
    texts = spark.createDataFrame([(f"the text of number {'abcdefghij'[i % 10]} {i}",) for i in range(400)], "text string")
    unit = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 30))
    copied = texts.orderBy(unit).first().text  # drawn under any share
    rows = [(copied, "en")] * 400 + [(f"ein satz von {i} wörtern", "de") for i in range(5)] + [(f"une phrase de {i} mots", "fr") for i in range(5)]
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)
    for order in ("doc_id", F.desc("doc_id")):
        model = language.learn(docs.orderBy(order), F.lit(True), sample=20)
        assert sorted(sum(model.families, [])) == ["de", "en", "fr"]
