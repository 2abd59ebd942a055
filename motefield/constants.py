"""Thresholds, sizes and lists that define the results."""

# fixed values: cleaning of a scene
CEILING_PCT_ID = 10.0
CEILING_PCT_EXTRACT = 3.0
FLOOR_BUFFER_M = 0.35
MAX_SCALE_M = 0.5
ANISO_RATIO = 20.0
TOP_BAND_PCT = 10.0
TOP_MAX_SCALE_M = 0.10
DENSITY_VOXEL_M = 0.10
DENSITY_MIN = 25
COLOUR_VOXEL_M = 0.20
COLOUR_BAND_PCT = 95.0
COLOUR_SCENE_PCT = 99.0
STRIP_CEILING_PCT = 40.0
STRIP_HEIGHT_M = 2.13
STRIP_VOXEL_M = 0.05
STRIP_MIN = 15
DENSITY_LADDER = [("A", 3), ("B", 10), ("C", 25), ("D", 60), ("E", 150)]

# fixed values: colour and encoding
SH_C0 = 0.28209479177387814
BRIGHTNESS_C = 0.28

# fixed values: floor band
FLOOR_UPPER_M = 0.18
FLOOR_THRESH_M = 0.10
FLOOR_COS = 0.3
FLOOR_LADDER = [0.05, 0.10, 0.15, 0.20, 0.35]
FLOOR_THRESH_MIN = 0.01
FLOOR_THRESH_MAX = 0.50

# fixed values: streak removal
STREAK_LADDER = [("conservative", 0.15, 0.20), ("default", 0.10, 0.25), ("moderate", 0.08, 0.30),
                 ("aggressive", 0.06, 0.35), ("very_aggressive", 0.05, 0.42)]
STREAK_BAND = 0.25
STREAK_SCALE_M = 0.07
STREAK_ANISO = 4.0
STREAK_ISO_PCT = 90.0

# fixed values: masks and votes
SCORE_LADDER = [0.30, 0.45, 0.60, 0.75, 0.85]
RIGID_CAP = 0.60
COLLAPSE_DROP = 0.22
MIN_MASK_PX = 2000
MIN_PROMPT_PX = 50
MIN_VIEW_PX = 200
MIN_HIT_VIEWS = 3
MIN_CHILD_VIEWS = 5
WIDE_VOTE_FRAC = 0.6
TIGHT_VOTE_FRAC = 0.7
VOTE_SWEEP = [0.40, 0.60, 0.80]
BOX_VOTE_FRAC = 0.6
ART_VOTE_FRAC = 0.5
TV_VOTE_FRAC = 0.5
CHILD_VOTE_FRAC = 0.5
WIDE_PAD_M = 0.15
TIGHT_PAD_SOFT_M = 0.10
TIGHT_PAD_HARD_M = 0.035

# fixed values: boxes
HULL_PAD = 0.04
ART_PAD = 0.06
COMPANION_PAD = 0.06
WIDE_HULL_PAD = 0.10
NEIGHBOUR_PAD = 0.01
NEIGHBOUR_OVERLAP = 0.25
BOX_VOTE_PAD = 0.05
BOX_VOTE_TOP = 0.12
ART_VIEW_PAD = 0.03
RUG_PAD = 0.05
CROP_SIDE = 0.03
CROP_HEADROOM_M = 2.0
MIN_AREA_FURNITURE = 2500
MIN_AREA_ART = 1000
NMS_ANY_IOU = 0.5
NMS_LABEL_IOU = 0.9
MIN_COMPANION_SPLATS = 100

# fixed values: geometry of objects
RUG_BAND_M = 0.10
RUG_BELOW_M = 0.05
SIBLING_RADIUS_M = 0.05
MATCH_RADIUS_M = 1e-5
SLAB_HALF_M = 0.05
PARENT_XZ_PAD = 0.15
PARENT_Y_TOL = 0.10
CHILD_BOX_PAD = 0.02
WALL_REACH_M = 2.5

# fixed values: cameras
ORBIT_YAWS = [0, 30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 330]
ORBIT_PITCHES = [-15.0, -45.0]
TIGHT_EXTRA_YAWS = [355, 5]
LOW_PITCHES = [0.0]
STEEP_PITCHES = [-70.0]
TOPDOWN_PITCH = -89.0
REVIEW_FLAT_YAWS = [0, 45, 90, 135, 180, 225, 270, 315]
REVIEW_OBLIQUE_YAWS = [0, 90, 180, 270]
REVIEW_FLAT_PITCH = -20.0
REVIEW_OBLIQUE_PITCH = -50.0
REVIEW_FOV = 50.0
TV_PITCHES = [0, -15, -30, -45]
ART_YAWS = [0, 45, 90, 135, 180, 225, 270, 315]
FOV = 70.0
MARGIN_DISPLAY = 1.55
MARGIN_ORBIT = 2.0
MARGIN_LAMP = 1.4
MARGIN_TOPDOWN = 3.0
MARGIN_ART = 2.0
DIORAMA_BACK_M = 2.0
EYE_HEIGHT_M = 1.6

# fixed values: stages of an object, most refined first
STAGES = ["9_subtracted", "8_final", "7_final", "6_inside_outside", "5_subtracted",
          "5_bookshelf_sweep", "4_rug", "5_sweep_fallback", "4_sam_tight", "3_floor_drop",
          "2_pitch_sweep_refined", "2_sam_wide", "1_visual_hull"]
RUG_SIBLING_STAGES = ["5_sweep_fallback", "5_bookshelf_sweep", "4_sam_tight", "4_rug",
                      "3_floor_drop", "2_sam_wide"]
SCORE_INPUT_STAGES = ["5_subtracted", "5_bookshelf_sweep", "4_rug", "5_sweep_fallback",
                      "4c_sam_tight_high", "4b_sam_tight_low", "4_sam_tight"]
GROUP_STAGES = ["4_sam_tight", "1_visual_hull"]
SUBTRACT_STAGES = ["1_visual_hull", "2_sam_wide", "3_floor_drop", "4_sam_tight", "4_rug",
                   "5_sweep_fallback", "5_bookshelf_sweep", "5_subtracted", "2_pitch_sweep_refined"]
PICK_ORDER = ["6_inside_outside", "5_bookshelf_sweep", "5_sweep_fallback", "4b_sam_tight_low",
              "4_sam_tight", "3_floor_drop"]
CANONICAL_VIEWS = ["y0", "y90", "y180", "y270", "topdown"]
