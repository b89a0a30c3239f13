"""The whole job and its configuration."""
