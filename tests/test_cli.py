"""The command line lists every registered query with how it is checked."""

from pitchline.__main__ import main
from pitchline.plans.catalog import load_all


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert len(out) == len(load_all())
    assert any(line.startswith("mart_gamestate") and line.endswith("oracle") for line in out)
    assert any(line.startswith("ml_cv") and line.endswith("rows-only") for line in out)
