import pytest

from medledger.__main__ import main
from tests.test_sources import write_landing


def test_steps_and_exit_codes(claims, tmp_path, capsys):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    write_landing(claims, landing)
    assert main(["ingest", "--lake", root, "--landing", str(landing)]) == 0
    assert main(["quality", "--lake", root]) == 0
    assert main(["marts", "--lake", root]) == 0
    assert main(["views", "--lake", root]) == 0
    assert "version 1  v_pmpm" in capsys.readouterr().out
    assert main(["show", "--lake", root, "--view", "v_pmpm", "--version", "1"]) == 0
    p = landing / "members.csv"
    p.write_text(p.read_text() + p.read_text().splitlines()[-1] + "\n")
    assert main(["run", "--lake", root, "--landing", str(landing)]) == 2
    assert "U-MBR-ID" in capsys.readouterr().err


def test_rows_that_cannot_be_read(claims, tmp_path, capsys):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    write_landing(claims, landing)
    with open(landing / "diagnoses.csv", "a") as f:
        f.write("one field\n")
    assert main(["ingest", "--lake", root, "--landing", str(landing)]) == 3
    assert "1 rows" in capsys.readouterr().err
    assert main(["ingest", "--lake", root, "--landing", str(landing), "--keep-malformed"]) == 0


def test_landing_is_required():
    with pytest.raises(SystemExit):
        main(["run", "--lake", "x"])
    with pytest.raises(SystemExit):
        main(["show", "--lake", "x", "--view", "unknown"])
