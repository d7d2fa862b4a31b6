"""Plan-shaping helpers: size probes, series splitting, exact quantiles, time joins."""
