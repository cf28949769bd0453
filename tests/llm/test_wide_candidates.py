"""What the personal-data method adds to the base patterns."""

from slatewright.llm import personal_data
from slatewright.llm.queries import prepared

FOUND = {
    1: ("Tel. 030 1234567", "number:5:16"),
    2: ("please call (555) 010-9999 now", "number:12:26"),
    3: ("write to john at example dot com today", "address:9:32"),
    4: ("IBAN DE89 3704 0044 0532 0130 00 please", "account:5:32"),
    5: ("phone: 5551234567", "number:7:17"),
    6: ("my name is Maria Lopez and", "name:11:22"),
}
CLEAN = ["on 12-10-2024 and 2024-10-12", "chapter 10 20 30", "look at the dot there", "Version AB12 of it", "we met at noon", "Dear all", ""] * 4


def spans(spark, texts):
    prepared(spark)
    docs = spark.createDataFrame([(k, t) for k, t in texts], "doc_id int, text string")
    rows = personal_data.span_digest(personal_data.personal_spans(docs)).collect()
    return {r["id"]: r for r in rows}


def test_wide_candidates_are_found_and_others_voted_down(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    texts = [(k, t) for k, (t, _) in FOUND.items()] + [(100 + k, t) for k, t in enumerate(CLEAN)] + [(1000 + k, r.text) for k, r in enumerate(rows)]
    got = spans(spark, texts)
    assert {k: got[k]["spans"] for k in FOUND} == {k: want for k, (_, want) in FOUND.items()}
    assert {got[100 + k]["spans"] for k in range(len(CLEAN))} == {""}
    assert all(got[k]["n_phone"] == got[k]["n_email"] == 0 for k in FOUND)


def test_no_number_within_a_base_phone(spark):
    got = spans(spark, [(1, "call +1 (555) 010-9999 or +49 30 1234567"), (2, "Tel. 030 1234567"), (3, "pay 4111 1111 1111 1111")])
    assert got[1]["spans"] == "phone:5:22,phone:26:40" and got[3]["spans"] == "card:4:23"
    assert personal_data.NUMBER.startswith("(?<!")


def test_account_check(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("DE89 3704 0044 0532 0130 00",), ("GB82WEST12345698765432",), ("DE89 3704 0044 0532 0130 01",)], "m string")
    assert [r[0] for r in rows.select(personal_data._checks_out(F.col("m"))).collect()] == [True, True, False]
