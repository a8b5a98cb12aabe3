"""Delivery of an output by mail: off by default, never fails a run, secrets kept out of messages."""

from __future__ import annotations

import mimetypes
import os
import re
import smtplib
from collections.abc import Callable, Sequence
from email.message import EmailMessage


def redacted(text: str, secrets: Sequence[str]) -> str:
    for secret in filter(None, secrets):
        text = text.replace(secret, "***")
    return re.sub(r"(?i)(password|token|secret)=\S+", r"\1=***", text)


def message(sender: str, recipient: str, subject: str, body: str, files: Sequence[str]) -> EmailMessage:
    out = EmailMessage()
    out["From"], out["To"], out["Subject"] = sender, recipient, subject
    out.set_content(body)
    for path in files:
        kind = (mimetypes.guess_type(path)[0] or "application/octet-stream").split("/", 1)
        with open(path, "rb") as f:
            out.add_attachment(f.read(), maintype=kind[0], subtype=kind[1], filename=os.path.basename(path))
    return out


def by_smtp(mail: EmailMessage, host: str, port: int, user: str = "", password: str = "") -> None:
    with smtplib.SMTP(host, port, timeout=30) as server:
        server.starttls()
        if user:
            server.login(user, password)
        server.send_message(mail)


def send_output(enabled: bool, recipient: str, files: Sequence[str], subject: str, body: str, transport: Callable[[EmailMessage], None], sender: str = "docsift@localhost", secrets: Sequence[str] = ()) -> tuple[bool, str]:
    """(sent, what went wrong); files that are missing are left out."""
    if not enabled or not recipient:
        return False, "mail is off"
    try:
        transport(message(sender, recipient, subject, body, [f for f in files if os.path.isfile(f)]))
    except Exception as e:  # delivery is best effort
        return False, redacted(f"{type(e).__name__}: {e}", secrets)
    return True, ""
