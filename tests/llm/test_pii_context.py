"""Disclosing terms: the whole 100 characters around an entity."""
from sheaf.llm import pii


def clean(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.text for r in pii.sanitise(df).collect()}


def test_numbers_and_other_entities_do_not_end_the_context(spark):
    card = [f"n{i} Wexford Zyxwine, born 1980, card 4111 1111 1111 1111 {'lorem ' * i}" for i in range(4)]
    mails = [f"n{i} Quarkling a{i}@b.org c{i}@d.org ann.lee@x-mail.co.uk {'ipsum ' * i}" for i in range(4)]
    far = [f"Remoteling {'x ' * 60} 10.0.0.255 {'dolor ' * i}" for i in range(4)]
    got = clean(spark, card + mails + far)
    for i in range(4):
        assert "exford" not in got[i] and "yxwine" not in got[i]
        assert "uarkling" not in got[4 + i]
        assert got[8 + i].startswith("Remoteling")        # farther than 100 characters
