"""What a Python worker keeps between tasks."""

import pickle

from pyspark import cloudpickle

from pickwise.llm import sentencepiece_codec
from pickwise.llm.queries import tokenizer_file


def test_tasks_of_a_worker_share_one_codec():
    codec_of = sentencepiece_codec.codec_of

    def task(raw):
        codec = codec_of(raw)
        codec.digest("one text after another")
        return codec

    raw = open(tokenizer_file("piece_bpe_32k.model"), "rb").read()
    sent = cloudpickle.dumps(task)  # a worker loads the function anew for every task
    first, second = (pickle.loads(sent)(raw) for _ in range(2))
    assert first is second and first.cache
    assert second.digest("one text after another")[2] == "one text after another"
