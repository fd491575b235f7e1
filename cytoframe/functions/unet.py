"""The layers of a U-Net on batches of images, as matrix products in numpy.

A network is the named arrays of a checkpoint; its depth, its width, whether it gates
its skips and how it grows images back are read off the names.  Normalisation is
folded into the kernels once, so that a layer is a product, a shift and a maximum.
"""

from __future__ import annotations

import numpy as np

#: The first parts of names in older checkpoints, and what they are called since.
OLDER_NAMES = {"inc.": "encoder.stem.", "encoders.": "encoder.down_blocks.", "decoders.": "decoder.up_blocks.", "outc.": "decoder.outc."}
EPS = 1e-5


def present_names(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays under their present names."""
    found = {}
    for name, value in arrays.items():
        old = next((o for o in OLDER_NAMES if name.startswith(o)), "")
        found[OLDER_NAMES.get(old, "") + name[len(old) :]] = value
    return found


def convolve(x: np.ndarray, kernel: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Images (n, channels, rows, columns) by a kernel (out, channels, k, k) of odd size, zeros around them: a product for each tap."""
    n, c, h, w = x.shape
    k = kernel.shape[-1]
    r = k // 2
    padded = np.pad(x, ((0, 0), (0, 0), (r, r), (r, r))) if r else x
    out = np.broadcast_to(shift[:, None].astype(x.dtype), (n, len(kernel), h * w)).copy()
    for i in range(k):
        for j in range(k):
            out += kernel[:, :, i, j] @ padded[:, :, i : i + h, j : j + w].reshape(n, c, h * w)
    return out.reshape(n, -1, h, w)


def pooled(x: np.ndarray) -> np.ndarray:
    """The maximum of each two by two pixels; an odd last row or column goes."""
    n, c, h, w = x.shape
    return x[:, :, : h // 2 * 2, : w // 2 * 2].reshape(n, c, h // 2, 2, w // 2, 2).max(axis=(3, 5))


def doubled(x: np.ndarray, kernel: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Each pixel as two by two, by a kernel (channels, out, 2, 2)."""
    n, c, h, w = x.shape
    o = kernel.shape[1]
    out = kernel.reshape(c, o * 4).T @ x.reshape(n, c, h * w)
    return out.reshape(n, o, 2, 2, h, w).transpose(0, 1, 4, 2, 5, 3).reshape(n, o, 2 * h, 2 * w) + shift[:, None, None].astype(x.dtype)


def _lines(size: int, to: int, dtype) -> np.ndarray:
    """The matrix that interpolates ``size`` values at ``to`` places from the first to the last."""
    at = np.linspace(0, size - 1, to) if to > 1 else np.zeros(1)
    low = np.minimum(at.astype(int), max(size - 2, 0))
    out = np.zeros((to, size))
    out[np.arange(to), low] += 1 - (at - low)
    out[np.arange(to), np.minimum(low + 1, size - 1)] += at - low
    return out.astype(dtype)


def stretched(x: np.ndarray, h: int, w: int) -> np.ndarray:
    """Images of another size, bilinear, corners on corners."""
    return _lines(x.shape[2], h, x.dtype) @ x @ _lines(x.shape[3], w, x.dtype).T


def _centred(x: np.ndarray, h: int, w: int) -> np.ndarray:
    """Zeros around images that are smaller, the larger half after them."""
    down, right = h - x.shape[2], w - x.shape[3]
    return np.pad(x, ((0, 0), (0, 0), (down // 2, down - down // 2), (right // 2, right - right // 2))) if down or right else x


class UNet:
    """A network for inference, from a checkpoint's named arrays."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = present_names(arrays)
        self.depth = len({n.split(".")[2] for n in self.arrays if n.startswith("encoder.down_blocks.")})
        if not self.depth or "decoder.outc.weight" not in self.arrays:
            raise ValueError("no U-Net's arrays")
        self.gated = any(n.startswith("decoder.attention_gates.") for n in self.arrays)
        self.blocks = {p: self._block(p) for p in ["encoder.stem", *[f"encoder.down_blocks.{k}.conv" for k in range(self.depth)], *[f"decoder.up_blocks.{k}.conv" for k in range(self.depth)]]}
        self.gates = [[self._normed(f"decoder.attention_gates.{k}.{part}", 0, 1) for part in ("W_g", "W_x", "psi")] for k in range(self.depth)] if self.gated else []
        self.channels = self.blocks["encoder.stem"][0][0].shape[1]
        self.classes = len(self.arrays["decoder.outc.weight"])

    def _normed(self, prefix: str, kernel_at: int, norm_at: int) -> tuple[np.ndarray, np.ndarray]:
        """A kernel with the normalisation after it, and its shift."""
        kernel, norm = self.arrays[f"{prefix}.{kernel_at}.weight"], f"{prefix}.{norm_at}."
        scale = self.arrays[norm + "weight"] / np.sqrt(self.arrays[norm + "running_var"] + EPS)
        return (kernel * scale[:, None, None, None]).astype(kernel.dtype), (self.arrays[norm + "bias"] - self.arrays[norm + "running_mean"] * scale).astype(kernel.dtype)

    def _block(self, prefix: str) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self._normed(f"{prefix}.conv", 0, 1), self._normed(f"{prefix}.conv", 3, 4)]

    def _twice(self, prefix: str, x: np.ndarray) -> np.ndarray:
        for kernel, shift in self.blocks[prefix]:
            x = np.maximum(convolve(x, kernel, shift), 0)
        return x

    def _grown(self, k: int, x: np.ndarray) -> np.ndarray:
        up = f"decoder.up_blocks.{k}.up"
        if f"{up}.weight" in self.arrays:
            return doubled(x, self.arrays[f"{up}.weight"], self.arrays[f"{up}.bias"])
        return convolve(stretched(x, 2 * x.shape[2], 2 * x.shape[3]), self.arrays[f"{up}.1.weight"], self.arrays[f"{up}.1.bias"])

    def _gate(self, k: int, skip: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The skip, weighed at each pixel by what the deeper layer sees there."""
        from_deep, from_skip, joint = self.gates[k]
        both = np.maximum(convolve(stretched(x, *skip.shape[2:]), *from_deep) + convolve(skip, *from_skip), 0)
        return skip * (1 + np.tanh(convolve(both, *joint) / 2)) / 2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Logits (n, classes, rows, columns) of images (n, channels, rows, columns); missing channels are zeros, further ones are not read."""
        x = x[:, : self.channels].astype(self.arrays["decoder.outc.weight"].dtype)
        if x.shape[1] < self.channels:
            x = np.pad(x, ((0, 0), (0, self.channels - x.shape[1]), (0, 0), (0, 0)))
        kept = [self._twice("encoder.stem", x)]
        for k in range(self.depth):
            kept.append(self._twice(f"encoder.down_blocks.{k}.conv", pooled(kept[-1])))
        x = kept.pop()
        for k in range(self.depth):
            skip = kept.pop()
            weighed = self._gate(k, skip, x) if self.gated else skip
            x = self._twice(f"decoder.up_blocks.{k}.conv", np.concatenate([weighed, _centred(self._grown(k, x), *skip.shape[2:])], axis=1))
        return convolve(x, self.arrays["decoder.outc.weight"], self.arrays["decoder.outc.bias"])
