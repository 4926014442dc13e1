"""Population search that refines a query point (NumPy, runs inside tasks).

A simplified Stochastic Fractal Search (Salimi, 2014): diffusion around the
incumbent with greedy replacement.  The objective is minimised.

  init   x[i] = lower + U * (upper - lower), fit[i] = f(x[i]); best b = first argmin
  for each generation, particle i (best row B read once per i), trial m:
         walk > 0 : t = B + N(0,1) * walk * (B - x[i])
         walk <= 0: t = x[i] + N(0,1) * 0.01 * (upper - lower)
         clip t to the box when clipping is on
         if f(t) <  fit[i]: x[i], fit[i] = t, f(t); if f(t) < fit[b]: b = i

Updates are immediate, so particles are sequential; the kernel vectorises
across *queries* instead (arrays ``[Q, P, d]``), each query drawing from its
own generator seeded by ``crc32(query bytes) ^ seed``.  The result therefore
depends only on the query and the options, never on batching, partitioning,
task order or retries.

Random numbers: with ``stream="hash"`` every uniform is an integer hash of its
place in the stream (any engine can compute it) and normals are Box-Muller
pairs of them.  By default, NumPy ``Generator(SFC64(seed))``; standard normals come from
its ziggurat sampler, which draws the same N(0, 1) as Box-Muller at about a
quarter of the cost.  Streams are reproducible for a given NumPy version.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

# Default options of the refinement, equal to the reference's
# constants (generations 30, population 50, diffusion trials 2, walk 0.5,
# search box [-1, 1] in every dimension, bound clipping on), plus the
# local-walk step 0.01 of the box width.
DEFAULT_GENERATIONS = 30
DEFAULT_POPULATION = 50
DEFAULT_DIFFUSION = 2
DEFAULT_WALK = 0.5
DEFAULT_LOWER = -1.0
DEFAULT_UPPER = 1.0
DEFAULT_CLIP = True
LOCAL_STEP = 0.01


@dataclass(frozen=True)
class RefineOptions:
    generations: int = DEFAULT_GENERATIONS
    population: int = DEFAULT_POPULATION
    diffusion: int = DEFAULT_DIFFUSION
    walk: float = DEFAULT_WALK
    lower: float | tuple = DEFAULT_LOWER
    upper: float | tuple = DEFAULT_UPPER
    clip: bool = DEFAULT_CLIP
    seed: int = 0
    stream: str = "sfc64"

    def box(self, dim: int):
        lo = np.broadcast_to(np.asarray(self.lower, dtype=np.float64), (dim,)).copy()
        hi = np.broadcast_to(np.asarray(self.upper, dtype=np.float64), (dim,)).copy()
        return lo, hi

    def key(self):
        return (self.generations, self.population, self.diffusion, float(self.walk),
                np.asarray(self.lower, dtype=np.float64).tobytes(),
                np.asarray(self.upper, dtype=np.float64).tobytes(), bool(self.clip),
                int(self.seed), self.stream)


# Fixed values of the hash stream: a prime modulus and three multipliers.
HASH_MODULUS = 2147483647
HASH_STEP, HASH_FIRST, HASH_SECOND = 7919, 16807, 48271


class HashStream:
    """Uniforms by integer hashing of ``(seed, place)``, normals by Box-Muller.

    The same for every query of a seed; a search needs
    ``(population + 2 generations population diffusion) * dim`` uniforms.
    """

    def __init__(self, seed: int):
        self.seed, self.place = int(seed) % HASH_MODULUS, 0

    def random(self, shape) -> np.ndarray:
        n = int(np.prod(shape))
        i = np.arange(self.place, self.place + n, dtype=np.int64)
        self.place += n
        h = (self.seed + HASH_STEP * (i + 1)) % HASH_MODULUS
        h = (h * HASH_FIRST % HASH_MODULUS + i % HASH_MODULUS) * HASH_SECOND % HASH_MODULUS
        return (h / float(HASH_MODULUS)).reshape(shape)

    def standard_normal(self, shape, out: np.ndarray) -> None:
        u = self.random((*shape, 2))
        np.multiply(np.sqrt(-2 * np.log(np.maximum(u[..., 0], 1e-300))), np.cos(2 * np.pi * u[..., 1]), out=out)


def random_stream(opts: RefineOptions, query: np.ndarray):
    """A query's source of uniforms and normals."""
    if opts.stream == "hash":
        return HashStream(opts.seed)
    if opts.stream != "sfc64":
        raise ValueError(f"unknown random stream {opts.stream!r}")
    return np.random.Generator(np.random.SFC64(int(query_seed(query, opts.seed))))


def query_seed(query: np.ndarray, seed: int) -> int:
    """Seed of a query's random stream: crc32 of its canonical float64 bytes."""
    q = np.asarray(query, dtype=np.float64) + 0.0          # -0.0 -> 0.0
    q = np.where(np.isnan(q), np.nan, q)                   # one NaN payload
    return (zlib.crc32(q.tobytes()) ^ (int(seed) & 0xFFFFFFFF)) & 0xFFFFFFFF


class CosineObjective:
    """f(x) = 1 - x.q / (|q| |x|), a zero norm counted as 1 (per query)."""

    def __init__(self, queries: np.ndarray):
        q = np.asarray(queries, dtype=np.float64)                   # (Q, d)
        nq = np.sqrt(np.einsum("qd,qd->q", q, q))
        nq = np.where(nq == 0, 1.0, nq)
        self.unit = q / nq[:, None]                                 # q / |q|, zero stays zero

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # x: (Q, d) or (Q, P, d); errors are silenced by the caller
        if x.ndim == 2:
            dot = np.einsum("qd,qd->q", x, self.unit)
            nx = np.sqrt(np.einsum("qd,qd->q", x, x))
        else:
            dot = np.einsum("qpd,qd->qp", x, self.unit)
            nx = np.sqrt(np.einsum("qpd,qpd->qp", x, x))
        nx[nx == 0] = 1.0
        dot /= nx
        return 1.0 - dot


def set_distances(points: np.ndarray, members: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """``min_i cosdist(x, s_i)`` of each point over some members; a zero norm makes a distance 1."""
    nx = np.sqrt(np.einsum("nd,nd->n", points, points))
    best = np.full(len(points), np.inf)
    for lo in range(0, len(members), chunk):
        s = members[lo:lo + chunk]
        ns = np.sqrt(np.einsum("nd,nd->n", s, s))
        with np.errstate(invalid="ignore", divide="ignore"):
            d = 1.0 - (points @ s.T) / (nx[:, None] * ns[None, :])
        d[(nx == 0)[:, None] | (ns == 0)[None, :]] = 1.0
        d = np.where(np.isnan(d), np.inf, d)                        # NaN never wins a min
        best = np.minimum(best, d.min(axis=1))
    return best


class SetState:
    """Particles of one search whose objective is evaluated elsewhere, a generation at a time."""

    def __init__(self, particles: np.ndarray, rng: np.random.Generator):
        self.particles, self.rng = particles, rng
        self.fits = np.full(len(particles), np.inf)
        self.best = 0

    def start(self, fits: np.ndarray):
        self.fits, self.best = fits.copy(), int(np.argmin(fits))

    def accept(self, trials: np.ndarray, fits: np.ndarray):
        """Each particle takes its trials in turn where they are strictly better."""
        for m in range(trials.shape[1]):
            better = fits[:, m] < self.fits
            self.particles[better] = trials[better, m]
            self.fits[better] = fits[better, m]
        if self.fits.min() < self.fits[self.best]:
            self.best = int(np.argmin(self.fits))


def query_box_start(dim: int, opts: RefineOptions, seed: int) -> SetState:
    """Random particles in the search box."""
    rng = np.random.Generator(np.random.SFC64(int(seed)))
    lo, hi = opts.box(dim)
    return SetState(lo + rng.random((int(opts.population), dim)) * (hi - lo), rng)


def step_all(state: SetState, opts: RefineOptions) -> np.ndarray:
    """All trials ``(particle, trial, dim)`` of a generation, around one incumbent."""
    size, dim = state.particles.shape
    lo, hi = opts.box(dim)
    noise = state.rng.standard_normal((size, int(opts.diffusion), dim))
    x = state.particles[:, None, :]
    if float(opts.walk) > 0:
        incumbent = state.particles[state.best]
        out = incumbent + noise * float(opts.walk) * (incumbent - x)
    else:
        out = x + noise * (LOCAL_STEP * (hi - lo))
    return np.clip(out, lo, hi) if opts.clip else out


def _first_best(fit: np.ndarray) -> np.ndarray:
    """Index of the first strict minimum per row, as a sequential `<` scan does."""
    masked = np.where(np.isnan(fit), np.inf, fit)
    b = masked.argmin(axis=1)
    return np.where(np.isnan(fit[:, 0]), 0, b)


def refine(queries: np.ndarray, opts: RefineOptions, objective=None,
           seeds: np.ndarray | None = None, want_population: bool = False):
    """Refine ``Q`` queries of one dimension together.

    Returns ``(best_point (Q, d), best_fit (Q,))`` and, with
    ``want_population``, also ``(population (Q, P, d), fits (Q, P))``.
    """
    queries = np.asarray(queries, dtype=np.float64)
    Q, d = queries.shape
    P, G, M = int(opts.population), int(opts.generations), int(opts.diffusion)
    if P < 1:
        raise ValueError("population must be >= 1")
    lo, hi = opts.box(d)
    span = hi - lo
    f = objective if objective is not None else CosineObjective(queries)
    if seeds is None:
        rngs = [random_stream(opts, q) for q in queries]
    else:
        rngs = [np.random.Generator(np.random.SFC64(int(s))) for s in seeds]

    # particle-major layout: the slices touched in the sequential loop,
    # X[i] and Z[i, m], are contiguous (Q, d) blocks
    X = np.empty((P, Q, d))
    for q in range(Q):
        X[:, q] = lo + rngs[q].random((P, d)) * span
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        fit = np.ascontiguousarray(f(X.transpose(1, 0, 2)).T)        # (P, Q)
        b = _first_best(fit.T)
        qi = np.arange(Q)
        walk = float(opts.walk)
        local_step = LOCAL_STEP * span
        t = np.empty((Q, d))
        draw = np.empty((P, M, d))
        Z = np.empty((P, M, Q, d))
        for _ in range(G):
            for q in range(Q):
                rngs[q].standard_normal((P, M, d), out=draw)
                Z[:, :, q, :] = draw
            if walk > 0:
                Z *= walk
            else:
                Z *= local_step
            for i in range(P):
                B = X[b, qi]                               # copy: fixed for this i
                xi = X[i]
                fi = fit[i]
                for m in range(M):
                    if walk > 0:                           # t = B + z * (B - x_i)
                        np.subtract(B, xi, out=t)
                        t *= Z[i, m]
                        t += B
                    else:                                  # t = x_i + z * step
                        np.add(xi, Z[i, m], out=t)
                    if opts.clip:
                        np.maximum(t, lo, out=t)
                        np.minimum(t, hi, out=t)
                    ft = f(t)
                    imp = ft < fi
                    if imp.any():
                        xi[imp] = t[imp]
                        fi[imp] = ft[imp]
                        better = imp & (ft < fit[b, qi])
                        if better.any():
                            b = np.where(better, i, b)
    best = X[b, qi].copy()
    best_fit = fit[b, qi].copy()
    if want_population:
        return best, best_fit, X.transpose(1, 0, 2).copy(), fit.T.copy()
    return best, best_fit
