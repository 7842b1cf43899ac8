"""Disk of operator 1 between its steps."""

import pathlib

from profilekit.llm import lm_scoring
from profilekit.session import SHUFFLE_CLEANUP_CONF


def test_language_model_leaves_no_shuffle_files(spark, nasty):
    def held():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {p for d in folders for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}

    before, setting = held(), spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    found = lm_scoring.score_texts(nasty)
    left = held() - before
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == setting and found.count() == nasty.count()
