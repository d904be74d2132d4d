"""Plans that serve several operators: the rollup, global ranks and the result set."""
