"""The command line answers one request from a JSON-lines catalog."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_prints_top_items():
    lines = [
        '{"sku":"lamp","attributes":{"colour":"red","room":"hall","watts":"40"}}',
        '{"sku":"torch","attributes":{"colour":"blue","room":"hall","watts":"40"}}',
        '{"sku":"candle","attributes":{"colour":"red","room":"kitchen","wax":"yes"}}',
        '{"sku":"broken","attributes":',
    ]
    folder = tempfile.mkdtemp(prefix="likewise-cli-")
    path = os.path.join(folder, "catalog.jsonl")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    run = subprocess.run(
        [sys.executable, "-m", "likewise", "--catalog", path, "--sku", "lamp", "--num", "5",
         "--master", "local[2]"],
        cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    out = run.stdout
    assert out.index("torch") < out.index("candle")       # two matches beat one
    assert "1 catalog lines were rejected" in run.stderr
    missing = subprocess.run(
        [sys.executable, "-m", "likewise", "--catalog", path, "--sku", "nope",
         "--master", "local[2]"],
        cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert missing.returncode == 2 and "not in the catalog" in missing.stderr
