"""Account numbers followed by capitals and digits."""

from rosterline.llm import personal_data


def test_what_follows_an_account_number(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 Please pay", "DE89370400440532013000 BIC COBADEFF", "GB82WEST12345698765432 GB82WEST12345698765433 DE89370400440532013000 12", "DE89370400440532013000X", "NO9386011117947 2024"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [[(s.start, s.end) for s in r.iban] for r in personal_data.scan(df).orderBy("doc_id").collect()]
    assert found == [[(5, 32)], [(0, 22)], [(0, 22), (46, 68)], [], [(0, 15)]]
