"""The reference's jobs, re-expressed as DataFrame plans."""
