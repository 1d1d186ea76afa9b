"""Graphs of dense steps for onnxruntime: several array operations in one run, whose results in between stay in its
own memory.

A graph is written down here byte by byte (protocol buffers), so the package ``onnx`` is not needed. Graphs run in
the calling thread and travel to executors without their session.
"""

from __future__ import annotations

import numpy as np

FLOAT, INT64 = 1, 7
MICROSOFT = "com.microsoft"


def _number(value: int) -> bytes:
    found = b""
    while value > 127:
        found += bytes([value & 127 | 128])
        value >>= 7
    return found + bytes([value])


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    data = value.encode() if isinstance(value, str) else value
    return _number(number << 3 | 2) + _number(len(data)) + data


def _attribute(name: str, value: int | str) -> bytes:
    kind, at = (2, 3) if isinstance(value, int) else (3, 4)
    return _field(1, name) + _field(at, value) + _field(20, kind)


def _tensor(name: str, kind: int, rank: int) -> bytes:
    sizes = b"".join(_field(1, _field(2, f"{name}_{i}")) for i in range(rank))
    return _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, sizes)))


def _constant(name: str, value: np.ndarray) -> bytes:
    kind = INT64 if value.dtype == np.int64 else FLOAT
    sizes = b"".join(_field(1, n) for n in value.shape)
    return sizes + _field(2, kind) + _field(8, name) + _field(9, value.tobytes())


class Graph:
    """Built node by node; every name is a float array unless its rank is given as an int64 one."""

    def __init__(self, floats: dict[str, int], numbers: dict[str, int], outputs: dict[str, int], **constants: np.ndarray):
        self.outputs, self.session = list(outputs), None
        self._nodes: list[bytes] = []
        self._rest = b"".join(_field(5, _constant(*c)) for c in constants.items())
        self._rest += b"".join(_field(11, _tensor(n, FLOAT, rank)) for n, rank in floats.items())
        self._rest += b"".join(_field(11, _tensor(n, INT64, rank)) for n, rank in numbers.items())
        self._rest += b"".join(_field(12, _tensor(n, FLOAT, rank)) for n, rank in outputs.items())

    def node(self, found: str, operator: str, *inputs: str, domain: str = "", **attributes: int | str) -> None:
        """``found``: names of its results, by blanks."""
        node = b"".join(_field(1, x) for x in inputs) + b"".join(_field(2, y) for y in found.split())
        node += _field(4, operator) + b"".join(_field(5, _attribute(*a)) for a in attributes.items())
        self._nodes.append(_field(1, node + _field(7, domain)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"session": None}

    def ready(self) -> bool:
        """Whether onnxruntime runs it here; asked once."""
        if self.session is None:
            try:
                import onnxruntime

                options = onnxruntime.SessionOptions()
                options.intra_op_num_threads = options.inter_op_num_threads = 1
                options.log_severity_level = 4
                versions = b"".join(_field(8, _field(1, d) + _field(2, v)) for d, v in (("", 17), (MICROSOFT, 1)))
                model = _field(1, 8) + versions + _field(7, b"".join(self._nodes) + _field(2, "step") + self._rest)
                self.session = onnxruntime.InferenceSession(model, options, providers=["CPUExecutionProvider"])
            except Exception:  # not installed, or a build without one of the operators
                self.session = False
        return self.session is not False

    def __call__(self, **inputs: np.ndarray) -> list[np.ndarray]:
        return self.session.run(self.outputs, inputs)
