import numpy as np
import pyarrow as pa

from txrisk.llm import buffers, toxicity_gru


def test_fit_sees_the_worst_of_all_windows():
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 5000, n)) for n in (1, 20, 33, 900, 1600, 4871)] + ["", " \n"]
    net = toxicity_gru.Network.random(7)
    batch = pa.RecordBatch.from_pydict({"number": list(range(len(texts))), "doc_id": list(range(len(texts))), "text": texts})
    found = {}
    for out in toxicity_gru._chosen_windows(net)(iter([batch])):
        found |= dict(zip(out.column("number").to_pylist(), out.column("part").to_pylist()))
    assert found.pop(6) is found.pop(7) is None
    for i, part in found.items():
        words = texts[i].split()
        every = [" ".join(words[at : at + toxicity_gru.WINDOW]) for at in range(0, max(1, len(words) - toxicity_gru.STRIDE), toxicity_gru.STRIDE)]
        scores = net.scores(*buffers.text_bytes(pa.array(every)))
        assert len(scores) < 25 or i > 2
        assert part.decode() in every
        assert np.isclose(scores[every.index(part.decode())], scores.max(), atol=1e-5)


def test_first_windows_are_of_the_whole_text():
    texts = [" ".join(f"w{i}" for i in range(1600))] * 400
    batch = pa.RecordBatch.from_pydict({"number": list(range(400)), "doc_id": list(range(400)), "text": texts})
    parts = {p for out in toxicity_gru._chosen_windows(None)(iter([batch])) for p in out.column("part").to_pylist()}
    assert len(parts) > 80  # of 99 windows
