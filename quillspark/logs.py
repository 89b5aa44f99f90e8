"""Log sinks: the console, a rotating text file, and warnings as JSON lines that Spark can read back."""

from __future__ import annotations

import json
import logging
import logging.handlers

#: What a record may tell of the work that it is about.
EXTRAS = ("file", "doc_id", "chunk", "page", "error", "elapsed")
TABLE = "ts string, level string, logger string, message string, " + ", ".join(f"{e} string" for e in EXTRAS)


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        out = {"ts": self.formatTime(record, "%Y-%m-%dT%H:%M:%S"), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        out |= {e: str(getattr(record, e)) for e in EXTRAS if getattr(record, e, None) is not None}
        if record.exc_info and "error" not in out:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False)


def set_up(text_file: str | None = None, json_file: str | None = None, level: int = logging.INFO, most_bytes: int = 20 << 20, keep: int = 5) -> logging.Logger:
    """The engine's logger with these sinks in place of earlier ones."""
    log = logging.getLogger("quillspark")
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    plain = logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")
    sinks = [(logging.StreamHandler(), plain, level)]
    if text_file:
        sinks.append((logging.handlers.RotatingFileHandler(text_file, maxBytes=most_bytes, backupCount=keep, encoding="utf-8"), plain, level))
    if json_file:
        sinks.append((logging.handlers.RotatingFileHandler(json_file, maxBytes=most_bytes, backupCount=keep, encoding="utf-8"), JsonLines(), logging.WARNING))
    for handler, formatter, least in sinks:
        handler.setFormatter(formatter)
        handler.setLevel(least)
        log.addHandler(handler)
    log.setLevel(level)
    return log
