"""Column expressions and the NumPy kernels used by the operators."""

from popcenter.functions.vectors import euclidean, parse_vector, sq_distance

__all__ = ["euclidean", "sq_distance", "parse_vector"]
