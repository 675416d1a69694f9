"""Values of env-style lines and passwords are found whole."""

import hashlib

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import secrets

TOKEN = hashlib.sha1(b"7").hexdigest()
CLOUD = "AKIA" + hashlib.md5(b"8").hexdigest()[:16].upper()


def values(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in sorted(secrets.scan(spark, docs).collect(), key=lambda r: r.start):
        assert texts[r.doc_id][r.start:r.stop] == r.value
        got.setdefault(r.doc_id, []).append((r.value, r.kind, r.secret))
    clean = {r.doc_id: r.text for r in secrets.redact(spark, docs).collect()}
    return got, [clean[i] for i in range(len(texts))]


def test_env_lines(spark):
    texts = [f"API_KEY={TOKEN}\n", f"export AWS_ACCESS_KEY_ID={CLOUD}\n", "password=Tr0ub4dor&3xyz!!9 end",
             f"AWS_S3_SECRET_ACCESS_KEY_2={TOKEN}\n", "token=" + "q8Zt2LmX" * 4 + "==;", f"digest={TOKEN} of the file"]
    got, clean = values(spark, texts)
    assert got[0] == [(TOKEN, "hex token", True)] and clean[0] == "API_KEY=[SECRET]\n"
    assert got[1] == [(CLOUD, "cloud key", True)] and clean[1] == "export AWS_ACCESS_KEY_ID=[SECRET]\n"
    assert got[2] == [("Tr0ub4dor&3xyz!!9", "token", True)] and clean[2] == "password=[SECRET] end"
    assert got[3][-1] == (TOKEN, "hex token", True) and clean[3] == "AWS_S3_SECRET_ACCESS_KEY_2=[SECRET]\n"
    assert got[4][0][0] == "q8Zt2LmX" * 4 + "==" and clean[4] == "token=[SECRET];"
    assert got[5] == [(TOKEN, "hex token", False)] and clean[5] == texts[5]


def test_long_password(spark):
    phrase = "!".join(hashlib.sha256(bytes([i])).hexdigest()[:9] for i in range(12))
    got, clean = values(spark, [f'password = "{phrase}" end', f"pwd={phrase}\n"])
    assert got[0][0][0] == got[1][0][0] == phrase
    assert clean == ['password = "[SECRET]" end', "pwd=[SECRET]\n"]
