"""Key-pair credentials. Key text is never logged."""

from __future__ import annotations

import logging
import re
from pathlib import Path

log = logging.getLogger(__name__)

# PEM markers.
ENCRYPTED = "-----BEGIN ENCRYPTED PRIVATE KEY-----"
PKCS8 = "-----BEGIN PRIVATE KEY-----"
PKCS1 = "-----BEGIN RSA PRIVATE KEY-----"
PEM = re.compile("-----BEGIN .*-----END ", re.DOTALL)


def read_pem(path: str | None) -> str:
    """A key file's text with LF line ends and no trailing blanks."""
    if not path:
        raise ValueError("no key path is set")
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"no key file at {path}")
    try:
        try:
            text = file.read_text("utf-8")  # line ends become LF
        except UnicodeDecodeError:
            text = file.read_text("latin-1")
    except OSError as e:
        raise OSError(f"can't read the key file {path}: {e.strerror}") from e
    return text.rstrip()


def key_options(path: str | None, passphrase: str | None = None) -> dict[str, str]:
    """Reader options for a PKCS#8 key; an encrypted one needs its passphrase."""
    pem = read_pem(path)
    if not PEM.search(pem):
        raise ValueError("the key file isn't PEM: BEGIN or END is missing")
    if ENCRYPTED in pem:
        if not passphrase:
            raise ValueError("the key is encrypted, and no passphrase is set")
        log.info("using an encrypted key with its passphrase")
        return {"pem_private_key": pem, "pem_private_key_passphrase": passphrase}
    if PKCS1 in pem:
        raise ValueError("the key is PKCS#1; convert it: openssl pkcs8 -topk8 -nocrypt -in OLD -out NEW")
    if PKCS8 not in pem:
        log.warning("the key has no PKCS#8 marker; passing it on as it is")
    log.info("using a key without encryption")
    return {"pem_private_key": pem}
