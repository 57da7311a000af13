"""Keys with letters of one case: one of each class is found, words and identifiers are not."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F
from test_text import python_spans

from linkscout.llm import secrets

LOWER, UPPER = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits
KEYS = {
    "base-36": "q7m2zk9x4tw1v8rj3yp5", "base-32": "JBSW4Y3DPEHPK3PXKR2G66DZNB5GK3TU", "upper": "Q7M2ZK9X4TW1V8RJ3YP5",
    "lower joined": "q7m2_zk9x4tw1v-8rj3yp5h6", "upper joined": "Q7M2+ZK9X4TW1V/8RJ3YP5H6==",
}
WORDS = (
    "user_account_settings_v2", "customer-order-history-2019", "thisisaverylongidentifier2", "org/apache/spark/sql/catalyst/v3",
    "wp-content/uploads/2019/05/image-1024x768", "ubuntu-18-04-lts-amd64-server", "MAX_CONNECTION_TIMEOUT_V2", "ISO8859_1_CHARACTER_SET",
    "sha256withrsaencryption", "en-us/library/windows/desktop/ms682425", "iphone11promax256gbspacegray",
)


def test_one_key_of_each_class(spark):
    texts = [f"before {k} after" for k in (*KEYS.values(), *WORDS)] + ["a" * 200_000 + "1", "A1" * 50_000 + "_", "a1-" * 50_000]
    out = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").where("doc_id < 16"))
    for r in out.collect():
        assert [m.found for m in r.added] == ([r.text.split()[1]] if r.doc_id < len(KEYS) else []), r.text
        assert [(m.start, m.kind, m.stop) for m in r.added] == python_spans(r.text)[1]
    # The patterns are linear in a long string.
    long = spark.createDataFrame([(t,) for t in texts[16:]], "text string")
    assert long.select(*[F.sum(F.col("text").rlike(p).cast("int")) for p, _ in secrets.CLASSES]).first() is not None


@pytest.mark.parametrize("alphabet,size,least", [
    (LOWER, 32, 0.97), (UPPER, 32, 0.97), (string.ascii_uppercase + "234567", 32, 0.9), (LOWER + "-_", 40, 0.95), (UPPER + "+/", 40, 0.95),
])
def test_random_keys(alphabet, size, least):
    draw = random.Random(6)
    keys = ["".join(draw.choice(alphabet) for _ in range(size)) for _ in range(1000)]
    assert sum(bool(sum(python_spans(k), [])) for k in keys) >= least * len(keys)


def test_words_have_no_class_without_digits():
    assert not any(re.search(p, w) for p, _ in secrets.CLASSES for w in ("thisisaverylongwordwithoutdigits", "a-list-of-words-joined", "0123456789"))
