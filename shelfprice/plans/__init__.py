"""Plan building blocks: staging, size-checked joins, exact quantiles, top-k."""
