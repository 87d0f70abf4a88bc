"""Secrets behind folders of letters."""

import pytest

from folia.llm import secret_scan

SECRETS = ["9f8KdLq02mZx7Rt5Vb1N", "T0kZ8qP1xR7mW3nB5vC9yL2dF4gH6jK"]
KEY = "wJalrXUtnFEMIK/7MDENGbPxRfiCYEXAMPLEKEY"


@pytest.mark.parametrize("folders", ["com/hook/", "/com/v/", "https://example.com/hooks/incoming/", "Org/MyService/API/"])
def test_secret_as_last_segment(spark, folders):
    df = spark.createDataFrame([(i, f"see é {folders}{s} end") for i, s in enumerate(SECRETS)], "doc_id int, text string")
    for r in secret_scan.scan_secrets(df).collect():
        assert [r.text[s.start : s.end] for s in r.secrets] == [SECRETS[r.doc_id]]


def test_key_with_a_slash_and_plain_paths(spark):
    texts = [KEY, "usr/local/share/dictionaries/words2024", "example/com/article/how-to-mend-3-bikes-in-2024", "com/view/3f2504e0-4f89-11d3-9a0c-0305e82c3301", "com/articles/views/a8f3k2Lq"]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert [got[0].text[s.start : s.end] for s in got[0].secrets] == [KEY]
    assert all(not got[i].secrets for i in range(1, len(texts)))
