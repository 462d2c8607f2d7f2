"""Column-level functions: time axes, physics, angles and HEALPix index arithmetic."""
