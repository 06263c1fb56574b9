"""Folders of a state, and starting scripts for what differs from state to state."""

from __future__ import annotations

import re
from pathlib import Path

FOLDERS = {
    "state_dir": "", "raw_data_dir": "raw", "kinder_dir": "raw/kindergarten", "doe_dir": "raw/department", "greatschools_dir": "raw/directory",
    "vaxview_dir": "raw/surveys", "state_school_dir": "raw/other", "temp_data_dir": "cleaning/temp", "outputs_data_dir": "cleaning/output",
    "state_geo_dir": "places", "clean_data_dir": "cleaned",
}
SCRIPTS = {
    "download": '''"""Download step of {STATE}: returns the raw tables by name."""


def download(spark, paths):
    return {{"kinder": spark.read.csv(str(paths["kinder_dir"]), header=True), "department": spark.read.csv(str(paths["doe_dir"]), header=True)}}
''',
    "cleaning": '''"""Cleaning step of {STATE}: raw records to the columns of musterline.sources.cleaners."""

from musterline.sources import cleaners


def clean(tables):
    return cleaners.kindergarten(tables["kinder"]), cleaners.department(tables["department"])
''',
}


def state_code(state: str) -> str:
    if not isinstance(state, str) or not re.fullmatch("[A-Za-z]{2}", state):
        raise ValueError(f"a state is two letters, not {state!r}")
    return state.lower()


def folders(root: str, state: str) -> dict[str, Path]:
    """Makes the folders of a state and names them; what is there stays."""
    base = Path(root) / "states" / state_code(state)
    paths = {name: base / part for name, part in FOLDERS.items()} | {"general_data_dir": Path(root) / "data"}
    for path in paths.values():
        path.mkdir(parents=True, exist_ok=True)
    return paths


def script(kind: str, state: str, folder: str, overwrite: bool = False) -> Path:
    """Writes the starting script ``download`` or ``cleaning`` of a state; one that exists is kept unless told otherwise."""
    target = Path(folder) / f"{kind}_{state_code(state)}.py"
    if target.exists() and not overwrite:
        raise FileExistsError(str(target))
    target.write_text(SCRIPTS[kind].format(STATE=state.upper()))
    return target
