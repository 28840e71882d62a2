"""Words of texts as 64-bit numbers, and hashes of runs of words, for use inside tasks."""

import numpy as np
import xxhash

WORD_CACHE = 250_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

# Words of the decontamination contract: A-Z to lower case, every ASCII character but 0-9 and letters to a blank.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def utf8(column):
    """The values of an Arrow text column as bytes or None."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()


def split_words(data, lower=False):
    """Runs of anything but blank and \\x09-\\x0D in UTF-8 text; None has none. ``lower`` changes A-Z only."""
    if not data:
        return []
    return data.lower().split() if lower else data.split()


def plain_words(data):
    """Runs of 0-9, A-Z, a-z (in lower case) and everything outside ASCII; None has none."""
    return data.translate(_PLAIN).split() if data else []


class WordHashes(dict):
    """64-bit hashes of words, the first ``WORD_CACHE`` kept."""

    def __missing__(self, word):
        number = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = number
        return number

    def array(self, words):
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(numbers):
    """A bijection of 64-bit numbers that spreads their bits."""
    numbers = numbers ^ (numbers >> np.uint64(31))
    numbers = numbers * np.uint64(0xBF58476D1CE4E5B9)
    numbers ^= numbers >> np.uint64(29)
    numbers *= np.uint64(0x94D049BB133111EB)
    numbers ^= numbers >> np.uint64(32)
    return numbers


class RunHashes:
    """Rabin-Karp hashes modulo 2^64 of all runs of ``size`` numbers, by prefix sums."""

    def __init__(self):
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, length):
        if length > len(self._powers):
            length = max(length, 2 * len(self._powers))
            self._powers, self._inverses = (
                np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(length - 1, base, np.uint64))))
                for base in (np.uint64(_BASE), np.uint64(_INVERSE))
            )

    def windows(self, numbers, size):
        """One hash per start; ``len(numbers) - size + 1`` of them, none for shorter input."""
        count = len(numbers) - size + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        self._grow(len(numbers) + 1)
        sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(numbers * self._inverses[: len(numbers)], out=sums[1:])
        return mixed((sums[size:] - sums[:-size]) * self._powers[:count])

    def whole(self, numbers):
        """One hash of the whole run, apart from those of longer or shorter runs."""
        return self.windows(numbers, len(numbers)) ^ np.uint64(len(numbers))
