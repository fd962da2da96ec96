"""Writers. The only places that trigger jobs on purpose."""
