"""DataFrame operators of the Bronze -> Silver -> Gold model."""
