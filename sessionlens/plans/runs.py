"""Runs over recordings: names, provenance, manifests, stages with their status.

Everything here is driver work on small values; data stays in DataFrames that stages write.
"""

from __future__ import annotations

import hashlib
import re
import time
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from pathlib import Path

from ..functions.text import COMPACT_DATE, FRENCH_DATE, ISO_DATE, MONTH_NUMBERS
from ..sources.sinks import move_file, new_folder, save_json

STAGES = ("vad", "diarization", "transcription", "audio_audit", "segment_audit", "alignment", "turns", "person_extraction", "semantic_chunks", "tables")


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def _dated(stem: str) -> tuple[str | None, str]:
    """The date in a stem, and the text that says it."""
    for pattern in (ISO_DATE, COMPACT_DATE):
        if m := re.search(pattern, stem):
            return "-".join(m.groups()), m[0]
    if m := re.search(FRENCH_DATE, stem):
        return f"{m[3]}-{MONTH_NUMBERS[m[2].lower()]:02d}-{int(m[1]):02d}", m[0]
    return None, ""


def stem_date(stem: str) -> str | None:
    return _dated(stem)[0]


def slug(stem: str) -> str:
    said = _dated(stem)[1]
    bare = stem.replace(said, " ") if said else stem
    plain = unicodedata.normalize("NFKD", bare).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "-", plain).strip("-") or "session"


def file_hash(path: str | Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(1 << 20):
            h.update(part)
    return h.hexdigest()


@dataclass
class Run:
    """One recording on its way through the stages."""

    source: Path
    folder: Path
    sha256: str
    manifest: dict = field(default_factory=dict)

    @classmethod
    def begin(cls, source: str | Path, runs: str | Path, config: dict | None = None, today: date | None = None) -> Run:
        source = Path(source)
        sha = file_hash(source)
        name = f"{(today or date.today()).isoformat()}_{stem_date(source.stem) or 'no-date'}_{slug(source.stem)}_{sha[:8]}"
        run = cls(source, new_folder(Path(runs) / name), sha)
        run.manifest = {"schema_version": "1", "status": "running", "created_at": now(), "source": {"file": source.name, "sha256": sha, "date": stem_date(source.stem), "slug": slug(source.stem)}, "stages": []}
        run.save()
        save_json(config or {}, run.folder / "config.json")
        return run

    def save(self) -> None:
        save_json(self.manifest, self.folder / "manifest.json")

    def stage(self, name: str, work: Callable[[], dict[str, str] | None]):
        """Run a stage; its status, time and artifacts go to the manifest before and after."""
        entry = {"stage": name, "status": "running", "started_at": now()}
        self.manifest["stages"].append(entry)
        self.save()
        began = time.monotonic()
        try:
            made = work() or {}
        except Exception as e:
            entry |= {"status": "failed", "error_message": f"{type(e).__name__}: {e}"}
            self.manifest["status"] = "failed"
            raise
        else:
            relative = {k: str(Path(v).relative_to(self.folder)) if Path(v).is_relative_to(self.folder) else str(v) for k, v in made.items()}
            entry |= {"status": "completed", "artifacts": relative}
            return made
        finally:
            entry |= {"completed_at": now(), "duration_seconds": round(time.monotonic() - began, 3)}
            self.save()

    def finish(self, status: str = "completed") -> None:
        self.manifest |= {"status": status, "completed_at": now()}
        self.save()


def process(source: str | Path, root: str | Path, stages: dict[str, Callable[[Run], dict[str, str] | None]], config: dict | None = None) -> Run:
    """Take a recording through all stages in order; the file ends in ``processed`` or ``failed``.

    A file that isn't WAV is skipped with that status. After a failure no later stage runs.
    """
    root, source = Path(root), Path(source)
    run = Run.begin(source, root / "runs", config)
    if source.suffix.lower() != ".wav":
        run.finish("skipped_invalid_input")
        move_file(source, root / "failed")
        return run
    run.source = move_file(source, root / "processing")
    try:
        for name, work in stages.items():
            run.stage(name, lambda work=work: work(run))
    except Exception:
        run.finish("failed")
        run.source = move_file(run.source, root / "failed")
        raise
    run.finish()
    run.source = move_file(run.source, root / "processed")
    return run
