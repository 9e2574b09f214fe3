"""Prime factors of an integer column: the one Python function of the reports.

Spark has no expression for it, and a fold over candidate divisors would be
interpreted per row. The Arrow function divides whole batches by the small
primes at once; what is left of a number and may still be composite is taken
apart one by one. Every distinct value of a batch is factored a single time.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL = 1 << 12


def prime_factors(number: Column) -> Column:
    """Ascending prime factors with multiplicity, as array<bigint>; values up to 1 have none.

    Exact over the whole range of bigint. Null stays null.
    """

    # Nested, so that the functions travel by value and executors do not need
    # this package installed.
    def small_primes(limit):
        sieve = np.ones(limit, dtype=bool)
        sieve[:2] = False
        for p in range(2, int(limit**0.5) + 1):
            if sieve[p]:
                sieve[p * p :: p] = False
        return np.flatnonzero(sieve)

    def is_prime(n):
        # Miller-Rabin; these witnesses settle every number below 2 to the 64.
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for witness in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37):
            x = pow(witness, odd, n)
            if x in (1, n - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
        return True

    def divisor(n):
        # Pollard's rho: two walks modulo n meet modulo a divisor first.
        import math

        for shift in range(1, n):
            slow = fast = 2
            common = 1
            while common == 1:
                slow = (slow * slow + shift) % n
                fast = (fast * fast + shift) % n
                fast = (fast * fast + shift) % n
                common = math.gcd(slow - fast, n)
            if common != n:
                return common

    def large_factors(n):
        if n < SMALL * SMALL or is_prime(n):
            return [n]
        root = round(n**0.5)
        part = root if root * root == n else divisor(n)
        return sorted(large_factors(part) + large_factors(n // part))

    def factor_all(values, primes):
        found = {int(v): [] for v in values}
        open_values = values[values > 1]
        rest = open_values.copy()
        for p in primes:
            done = rest < p * p
            for v, r in zip(open_values[done], rest[done]):
                if r > 1:
                    found[int(v)].append(int(r))
            open_values, rest = open_values[~done], rest[~done]
            if not rest.size:
                break
            hit = np.flatnonzero(rest % p == 0)
            while hit.size:
                for v in open_values[hit]:
                    found[int(v)].append(int(p))
                rest[hit] //= p
                hit = hit[rest[hit] % p == 0]
        for v, r in zip(open_values, rest):
            if r > 1:
                found[int(v)] += large_factors(int(r))
        return found

    @F.pandas_udf("array<bigint>")
    def factors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        primes = small_primes(SMALL)
        for batch in batches:
            found = factor_all(batch.drop_duplicates().to_numpy(dtype="int64"), primes)
            yield batch.map(lambda n: found[int(n)])

    # Nulls are kept away: pandas would turn the whole batch to floats.
    whole = number.cast("bigint")
    return F.when(whole.isNotNull(), factors(F.coalesce(whole, F.lit(0))))
