"""Sky-map analytics on Spark: photon tables in, calibrated maps out."""
