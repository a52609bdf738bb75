"""SHA-256 that can be put down and taken up again elsewhere.

`hashlib` keeps its running state to itself. OpenSSL, which it calls, has the
state as a plain struct; its bytes are what one task hands to the next.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
from collections.abc import Iterable
from functools import lru_cache


class _Context(ctypes.Structure):
    """SHA256_CTX of openssl/sha.h."""

    _fields_ = [
        ("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32),
        ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("md_len", ctypes.c_uint),
    ]


@lru_cache(maxsize=1)
def _library():
    """OpenSSL's library, None where there is none that works as expected."""
    for name in ("libcrypto.so.3", "libcrypto.so.1.1", ctypes.util.find_library("crypto")):
        try:
            lib = ctypes.CDLL(name) if name else None
            if lib is None:
                continue
            lib.SHA256_Init.argtypes = [ctypes.c_void_p]
            lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
            lib.SHA256_Final.argtypes = [ctypes.c_char_p, ctypes.c_void_p]
        except (OSError, AttributeError):
            continue
        if _finish(lib, _update(lib, _start(lib), [b"leptide" * 20]), b"\n") == hashlib.sha256(b"leptide" * 20 + b"\n").hexdigest():
            return lib
    return None


def _start(lib) -> bytes:
    context = _Context()
    lib.SHA256_Init(ctypes.byref(context))
    return bytes(context)


def _update(lib, state: bytes, chunks: Iterable[bytes]) -> bytes:
    context = _Context.from_buffer_copy(state)
    for chunk in chunks:
        lib.SHA256_Update(ctypes.byref(context), chunk, len(chunk))
    return bytes(context)


def _finish(lib, state: bytes, tail: bytes) -> str:
    context = _Context.from_buffer_copy(_update(lib, state, [tail]))
    digest = ctypes.create_string_buffer(32)
    lib.SHA256_Final(digest, ctypes.byref(context))
    return digest.raw.hex()


def _required():
    lib = _library()
    if lib is None:
        raise RuntimeError("no OpenSSL library whose SHA-256 state can be kept")
    return lib


def available() -> bool:
    return _library() is not None


def start(head: bytes = b"") -> bytes:
    """State after `head`."""
    lib = _required()
    return _update(lib, _start(lib), [head])


def update(state: bytes, chunks: Iterable[bytes]) -> bytes:
    """State after further bytes."""
    return _update(_required(), state, chunks)


def finish(state: bytes, tail: bytes = b"") -> str:
    """Hexadecimal digest after `tail`."""
    return _finish(_required(), state, tail)
