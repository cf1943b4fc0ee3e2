"""Record linkage and corpus preparation as DataFrame plans."""
