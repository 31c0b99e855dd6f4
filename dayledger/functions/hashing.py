"""Deterministic pseudo-random numbers keyed by a row id.

`rand(seed)` depends on how rows are partitioned, so a recomputed task or another
cluster size gives other numbers. Everything here is a pure function of the id,
in bigint arithmetic that stays below 2**62, so it runs in codegen, survives lost
executors and has the same value in any SQL engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# The prime modulus 2**31 - 1 and multipliers for id, high part of
# the id, stream and seed.
PRIME = 2147483647
ID_STEP = 48271
HIGH_STEP = 40014
STREAM_STEP = 69621
SEED_STEP = 16807


def hash31(key: Column, stream: int = 0, seed: int = 42) -> Column:
    """Integer in [0, 2**31 - 2]: an affine map of the id, then x**5 mod p.

    The fifth power is a bijection modulo this prime (5 does not divide p - 1),
    so ids below p never collide within one stream.
    """
    shift = (stream * STREAM_STEP * SEED_STEP + seed * SEED_STEP + STREAM_STEP) % PRIME
    key = key.cast("bigint")
    low = F.pmod(key, F.lit(PRIME)) * ID_STEP
    high = F.pmod(F.shiftright(key, 31), F.lit(PRIME)) * HIGH_STEP
    x = (low + high + shift) % PRIME
    square = (x * x) % PRIME
    return (((square * square) % PRIME) * x) % PRIME


def uniform(key: Column, stream: int, seed: int = 42) -> Column:
    """Double strictly between 0 and 1."""
    return (hash31(key, stream, seed) + 0.5) / float(PRIME)


def uniform_int(key: Column, stream: int, low: int, high: int, seed: int = 42) -> Column:
    """Integer in [low, high)."""
    return (F.floor(uniform(key, stream, seed) * (high - low)) + low).cast("int")


def bernoulli(key: Column, stream: int, p: Column, seed: int = 42) -> Column:
    return (uniform(key, stream, seed) < p).cast("int")


def exponential(key: Column, stream: int, scale: Column, seed: int = 42) -> Column:
    return -scale * F.ln(uniform(key, stream, seed))


def standard_normal(key: Column, stream: int, seed: int = 42) -> Column:
    """Box-Muller over two streams: `stream` and `stream + 1`."""
    radius = F.sqrt(-2.0 * F.ln(uniform(key, stream, seed)))
    return radius * F.cos(2.0 * math.pi * uniform(key, stream + 1, seed))
