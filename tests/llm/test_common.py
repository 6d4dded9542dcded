import sys

from chunkloom.llm.common import kept_in_process


def test_a_worker_keeps_what_its_stage_needs_and_no_more(monkeypatch):
    """Values of earlier stages go when one of another kind is made, but for those named beside it."""
    monkeypatch.delitem(sys.modules, "_kept_between_tasks", raising=False)
    made = []

    def make(name):
        return lambda: made.append(name) or name

    assert kept_in_process("ids", None, make("ids")) == "ids"
    assert kept_in_process("ids", None, make("again")) == "ids"
    assert kept_in_process("encoder", "a", make("a")) == "a"
    assert kept_in_process("words", "a", make("words"), beside=("encoder",)) == "words"
    assert kept_in_process("encoder", "a", make("not made")) == "a"
    assert kept_in_process("ids", None, make("made anew")) == "made anew"
    assert kept_in_process("encoder", "b", make("b")) == "b"
    assert made == ["ids", "a", "words", "made anew", "b"]
