"""DataFrame operators the studies are composed of."""
